"""Each operator on awkward tables, and each query against a brute-force version."""

import collections
import functools
import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rideframe.llm import chat, chosen_path, fertility, links, packing, pq_dedup, simple8b, token_cache, toxicity, url_rules
from rideframe.llm.merge_replay import decode_documents, encode_documents, read_ranks
from rideframe.llm.queries import ORACLES, QUERIES
from rideframe.session import new_shared_path
from tests.llm.data import LONG, ODD_TEXTS, SF_DIR, no_docs, odd_docs, texts_of
from tools.check_oracle import cell, connect

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def rows_by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = connect(SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    relation = con.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    wanted = relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert sorted(tuple(map(cell, r)) for r in df.select(*columns).collect()) == sorted(tuple(map(cell, r)) for r in wanted)


# --- packing, encoding, files, counts -------------------------------------------------


def check_pieces(rows, wanted):
    """Every id in one piece, sequences without gaps, little padding."""
    parts, fills = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        parts[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        fills[r.sequence_id].append((r.offset, r.length))
    assert set(parts) == set(wanted)
    for doc, pieces in parts.items():
        at = 0
        for start, length, crc32, total in sorted(pieces):
            assert (start, total, crc32) == (at, len(wanted[doc]), crc(wanted[doc][start : start + length]))
            at += length
        assert at == len(wanted[doc])
    partly = 0
    for pieces in fills.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        partly += at < 2048
    return partly


def test_packing_query(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    wanted = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts_of()}
    df = QUERIES["op1_packing"](spark, SF_DIR)
    assert check_pieces(df.collect(), wanted) <= df.rdd.getNumPartitions()


def test_packing_of_odd_rows(spark):
    docs = odd_docs(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    library = Tokenizer.from_file(BYTE_BPE)
    wanted = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(ODD_TEXTS)}
    rows = packing.pack_documents(docs, BYTE_BPE).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(rows, wanted)
    assert packing.pack_documents(odd_docs(spark), BYTE_BPE).filter("doc_id is null").count() == 1
    assert packing.pack_documents(no_docs(spark), BYTE_BPE).count() == 0


def test_merge_replay_query(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    got = rows_by_id(QUERIES["op5_merge_replay"](spark, SF_DIR))
    for doc, text in texts_of():
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc] == (len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest())


def test_merge_replay_of_odd_rows(spark):
    encoded = encode_documents(odd_docs(spark), RANKS, public_tokenizers.PATTERN)
    decoded = decode_documents(encoded, RANKS).collect()
    assert len(decoded) == len(ODD_TEXTS) + 2
    for row in decoded:
        text = "some text" if row.doc_id is None else ODD_TEXTS[row.doc_id] or ""
        assert bytes(row.decoded) == text.encode() and row.n_tokens * 4 == len(row.ids)
    assert encode_documents(no_docs(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_files(spark):
    library = Tokenizer.from_file(WORD_BPE)
    start, got = 0, rows_by_id(QUERIES["op6_simple8b"](spark, SF_DIR))
    assert len(got) == len(texts_of())
    for doc, text in texts_of():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert got[doc] == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_of_odd_rows(spark):
    for docs, n in ((odd_docs(spark), len(ODD_TEXTS) + 2), (no_docs(spark), 0)):
        folder = new_shared_path(spark, "files")
        simple8b.write_token_files(docs, WORD_BPE, folder)
        rows = simple8b.read_token_files(spark, folder).orderBy("start").collect()
        assert len(rows) == n
        at = 0
        for row in rows:
            assert row.start == at and len(row.ids) == 4 * row.n_tokens
            at += row.n_tokens
        ids = [r.doc_id for r in rows]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_token_counts(spark):
    library = Tokenizer.from_file(WORD_BPE)
    got = rows_by_id(QUERIES["op10_token_counts"](spark, SF_DIR))
    for doc, text in texts_of():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert got[doc] == (len((text or "").encode()), n, n > 2048)


@pytest.mark.parametrize("path,normalise", [(WORD_BPE, token_cache.folded), (BYTE_BPE, token_cache.unchanged), (PIECES, token_cache.unchanged)])
def test_token_counts_of_odd_rows_and_a_warm_cache(spark, path, normalise):
    if path.endswith(".model"):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(library.encode(t))
    else:
        library = Tokenizer.from_file(path)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    cache = new_shared_path(spark, "cache")
    folder = f"{cache}/{token_cache.tokenizer_version(path)}"
    stored = []
    for _ in range(2):
        rows = token_cache.count_tokens(odd_docs(spark), path, cache, normalise=normalise).collect()
        assert len(rows) == len(ODD_TEXTS) + 2
        for r in rows:
            text = "some text" if r.doc_id is None else ODD_TEXTS[r.doc_id] or ""
            assert (r.n_bytes, r.n_tokens) == (len(text.encode()), count(text)), text[:40]
        stored.append(spark.read.parquet(folder).count())
    assert stored[0] == stored[1] <= len(ODD_TEXTS)
    assert token_cache.count_tokens(no_docs(spark), path, cache).count() == 0


# --- quality --------------------------------------------------------------------------


def base_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = collections.defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    repeated = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    seen, n_dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            n_dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), n_dup, len(repeated), failed


@functools.cache
def piece_model():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def brute_verdicts(rows):
    """base measures and verdict by id, for (id, text, lang) rows: declared bands and the limits of all the texts."""
    model, found, counts = piece_model(), {}, collections.defaultdict(collections.Counter)
    for doc, text, lang in rows:
        base = base_measures(text)
        tokens = [t for w in re.findall(r"[^\x20\x09-\x0D]+", text or "") for t in model.encode(w)]
        n = max(1, len(tokens))
        shares = np.array(list(collections.Counter(tokens).values())) / n
        chars, bits = base[1] / n, float(-(shares * np.log2(shares)).sum())
        kind = lang if lang in fertility.LANGUAGE_BANDS else "latin"
        length = int(np.log2(n))
        found[doc] = base, kind, length, n, chars, bits, sum(map(model.is_byte, tokens)) / n
        if not base[5]:
            for measure, value in enumerate((chars, bits)):
                for cell in ("all", "script", kind):
                    counts[cell, length, measure][int(np.floor(value * 1000))] += 1

    def mixed(own, wider):
        total = sum(own.values()) + 50
        return {b: (own[b] + 50 * wider.get(b, 0)) / total for b in own.keys() | wider.keys()}

    def quantile(shares, part):
        run = 0.0
        for b in sorted(shares):
            run += shares[b]
            if run >= part - 1e-9:
                return b

    verdicts = {}
    for doc, (base, kind, length, n, chars, bits, byte_share) in found.items():
        band = fertility.LANGUAGE_BANDS.get(kind) or fertility.SCRIPT_BANDS["latin"]
        low, needed = band.chars_per_token[0], min(band.token_bits, band.token_evenness * np.log2(n))
        kept = not base[5] and chars <= band.chars_per_token[1] and byte_share <= band.byte_share
        if kept:
            every = counts["all", length, 0].total()
            trust = every / (every + 50)
            for measure, (value, declared) in enumerate(((chars, low), (bits, needed))):
                whole = counts["all", length, measure]
                shares = mixed(counts["script", length, measure], {b: c / whole.total() for b, c in whole.items()})
                if kind != "latin":
                    shares = mixed(counts[kind, length, measure], shares)
                q1, q2, q3 = (quantile(shares, p) for p in (0.25, 0.5, 0.75))
                usual = (q2 - 2.5 * max(1, q3 - q1)) / 1000
                kept &= value >= max(declared, trust * usual + (1 - trust) * declared) - 1e-12
        verdicts[doc] = base, bool(kept)
    return verdicts


@pytest.mark.parametrize("folder", [SF_DIR, "/root/testdata/sf0.01"])
def test_quality_query(spark, folder):
    rows = duckdb.sql(f"select doc_id, text, lang from '{folder}/documents.parquet'").fetchall()
    got = rows_by_id(QUERIES["op2_fertility"](spark, folder))
    wanted = brute_verdicts(rows)
    assert {i: (tuple(r[:6]), r[6]) for i, r in got.items()} == wanted
    rejected = [not kept and not base[5] for base, kept in wanted.values()]
    assert sum(rejected) >= len(rows) // 100 or len(rows) < 500  # the limits act where there are texts enough


def test_quality_of_odd_rows(spark):
    rows = fertility.judge_quality(odd_docs(spark), PIECES).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    for row in rows:
        text = "some text" if row.doc_id is None else ODD_TEXTS[row.doc_id]
        assert tuple(row)[1:7] == base_measures(text)
    assert fertility.judge_quality(no_docs(spark), PIECES).count() == 0
    kept = fertility.drop_low_quality(odd_docs(spark), PIECES)
    assert kept.columns == odd_docs(spark).columns
    good = {r.doc_id for r in rows if r.kept}
    assert {r.doc_id for r in kept.collect()} == good
    clash = odd_docs(spark).withColumnRenamed("ids", "kind").withColumn("row", F.lit(1)).withColumn("n_words", F.lit("x"))
    kept = fertility.drop_low_quality(clash, PIECES)
    assert kept.columns == clash.columns and {r.doc_id for r in kept.collect()} == good


def test_bands_reject_noise_and_keep_prose(spark):
    prose = "The river rose after three days of rain, and by noon the lower road was closed to every cart from the mill."
    noise = "x7 q9z kk0 #4f 9a0b 7e7f aa01 b2c3 d4e5 f607 1829 3a4b 5c6d 7e8f 90a1 b2c3 d5e6 f708 192a 3b4c"
    dull = " ".join(["la"] * 3 + ["lo"] * 2) + " " + " ".join(f"la lo{'o' * (i % 2)}" for i in range(60))
    foreign = "Река поднялась после трёх дней дождя, и к полудню нижняя дорога была закрыта для всех телег с мельницы."
    docs = spark.createDataFrame([*enumerate([prose, noise, dull, foreign])], "doc_id int, text string").withColumn("lang", F.when(F.col("doc_id") < 3, "en"))
    found = {r.doc_id: r.kept for r in fertility.judge_quality(docs, PIECES).collect()}
    assert found == {0: True, 1: False, 2: False, 3: True}


# --- toxicity -------------------------------------------------------------------------


def test_toxicity_learns_subwords_and_never_held_out_labels(spark):
    """Misspelt words of an insult score like it; labels of held-out rows change nothing."""
    rng = np.random.default_rng(2)
    plain = ["river", "mill", "stone", "carried", "evening", "letter", "garden", "winter", "window", "answer"]
    bad = ["stupidest", "stupidly", "stupids", "stupidish"]
    rows, truth = [], []
    for i in range(900):
        words = rng.choice(plain, 40).tolist()
        if toxic := i % 3 == 0:
            words[5] = bad[i % 4]
        rows.append((i, " ".join(words)))
        truth.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (10_001, " ".join(["river mill stone"] * 12 + ["stupidoos"])), (10_002, " ".join(["river mill stone"] * 12 + ["gardens"]))], "doc_id long, text string")
    held = {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1}
    labels = spark.createDataFrame(truth, "doc_id long, toxic int")
    lied = spark.createDataFrame([(i, 1 - t if i in held else t) for i, t in truth], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    scores = rows_by_id(toxicity.score_toxicity(docs, model))
    right = [(scores[i][0] >= 0.7) == bool(t) for i, t in truth if i in held]
    assert np.mean(right) > 0.97
    assert scores[10_001][0] > 4 * scores[10_002][0]
    other = rows_by_id(toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, lied)))
    assert other == scores


def test_toxicity_of_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (99, 1), (5, 0), (7, None), (8, 5)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == len(ODD_TEXTS) + 2 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.drop_toxic(docs, model, 1.1).collect() == docs.collect()
    assert toxicity.drop_toxic(docs, model, 0.0).count() == 0
    empty = toxicity.train_toxicity(docs, labels.filter("doc_id < 0"))
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(docs, empty).collect())
    assert toxicity.score_toxicity(no_docs(spark), model).count() == 0


# --- links ----------------------------------------------------------------------------


def brute_components(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 180)] + [(500, 500), (7, 3), (200, 150)]
    got = rows_by_id(links.connected_components(spark.createDataFrame(edges, "a long, b long")))
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    wanted = brute_components(nodes, [e for e in edges if e[0] != e[1]])
    assert {k: v[0] for k, v in got.items()} == wanted
    assert links.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def check_documents(rows, texts):
    sets = {i: shingle_set(t) for i, t in texts}
    pairs = []
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and common / (len(sets[a]) + len(sets[b]) - common) >= 0.8:
                pairs.append((a, b))
    groups = brute_components(ids, pairs)
    counts = collections.Counter(x for p in pairs for x in p)
    got = {r.doc_id: (r.n_links, r.group_id, r.kept) for r in rows}
    assert got == {i: (counts[i], groups[i], groups[i] == i) for i in ids}


def test_jaccard_query(spark):
    check_documents(QUERIES["op3_jaccard_join"](spark, SF_DIR).collect(), texts_of())


def test_jaccard_join_of_a_large_group_of_near_copies(spark, monkeypatch):
    """More near copies than a bucket holds, with exact copies and shared passages among them."""
    monkeypatch.setattr(chosen_path, "BUCKET", 16)
    rng = np.random.default_rng(4)
    base = [f"t{i}" for i in range(120)]
    texts = []
    for i in range(150):
        words = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 4)):
            words[k] = f"u{rng.integers(0, 10**6)}"
        texts.append((i, " ".join(words)))
    texts += [(200 + i, texts[i][1]) for i in range(10)]
    texts += [(300 + i, " ".join(base[:40] + [f"v{i}_{k}" for k in range(60)])) for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check_documents(chosen_path.similar_documents(docs).collect(), texts)


def test_jaccard_join_of_odd_rows(spark):
    rows = chosen_path.similar_documents(odd_docs(spark)).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[6].class_id, by_id[6].n_links, by_id[6].kept) == (5, 2, False)
    assert (by_id[5].n_links, by_id[5].kept) == (2, True)
    assert (by_id[14].group_id, by_id[14].kept) == (13, False)
    assert [by_id[i].n_links for i in (0, 1, 2, 3, None)] == [0] * 5 and by_id[None].kept
    kept = chosen_path.drop_near_copies(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [i for i in range(15) if i not in (6, 14)]
    assert kept.filter("doc_id is null").count() == 1
    assert chosen_path.similar_documents(no_docs(spark)).count() == 0


def test_trees_for_a_recall():
    assert chosen_path.survival(0.8, 0) == 1
    assert 0.4 < chosen_path.survival(0.8, 4) < 0.7
    assert (1 - chosen_path.survival(0.8, 4)) ** chosen_path.runs_for(0.99, 0.8) <= 0.01


def check_vectors(rows, vectors):
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    pairs = []
    for n, (a, v, label) in enumerate(vectors):
        for b, w, other in vectors[n + 1 :]:
            if label is not None and label == other and good(v) and good(w) and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    pairs.append((a, b))
    ids = [v[0] for v in vectors]
    groups = brute_components(ids, pairs)
    counts = collections.Counter(x for p in pairs for x in p)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows} == {i: (counts[i], groups[i], groups[i] == i) for i in ids}


def test_vectors_with_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(pq_dedup, "TILE", 32)
    rng = np.random.default_rng(6)
    vectors = []
    for i in range(240):
        if i % 3 == 0:
            v = np.ones(16) + rng.normal(0, 0.06, 16)
        elif i % 3 == 1:
            v = rng.normal(0, 1, 16)
        else:
            v = np.eye(16)[i % 2] * 5
        vectors.append((i, [float(np.float32(x)) for x in v], i % 2))
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    check_vectors(pq_dedup.near_duplicate_vectors(df, n_lists=8, n_parts=4).collect(), vectors)


def test_vectors_of_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    vectors = [(1, v, 0), (2, v, 0), (3, v, None), (4, v, 1), (5, None, 0), (6, [0.0] * 3, 0), (7, [1.0, None, 2.0], 0), (8, [1.0, float("nan"), 2.0], 0)]
    vectors += [(9, [float("inf"), 1.0, 1.0], 0), (10, [2.0, 4.0, 6.0], 0), (11, [], 0), (12, [-1.0, 0.0, 0.0], 1), (13, [1e-30, 2e-30, 3e-30], 0), (14, [1e30, 2e30, 3e30], 0)]
    schema = "vec_id long, embedding array<float>, label int, node string, key string"
    df = spark.createDataFrame([(*r, "a", "b") for r in vectors], schema)
    check_vectors(pq_dedup.near_duplicate_vectors(df).collect(), vectors)
    [null] = pq_dedup.near_duplicate_vectors(spark.createDataFrame([(None, v, 0, "", "")], schema)).collect()
    assert (null.n_links, null.component_id, null.kept) == (0, None, True)
    assert pq_dedup.near_duplicate_vectors(df.filter("vec_id < 0")).count() == 0


# --- chat -----------------------------------------------------------------------------


def test_chat_round_trip_and_states(spark):
    control = "<|im_end|>\n<|im_start|>user\nx <| <\\| <\\\\|y <"
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", control), (1, 2, "assistant", control),
        (2, 0, "assistant", "first"), (2, 1, "user", None),
        (3, 0, "user", ""), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"),
        (4, 5, "user\nx<|nl|>", "odd role"), (None, None, None, None), (5, 0, "start", "q"), (5, 1, "user", "q"),
    ]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn int, role string, text string, segments int")
    whole = chat.format_conversations(df)
    read = whole.select("conv_id", "valid", chat.read_turns(F.col("formatted")).alias("turns"), chat.trained_text(F.col("segments")).alias("loss"))
    got = {r.conv_id: r for r in read.collect()}
    wanted = collections.defaultdict(list)
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] or 0)):
        wanted[conv].append((role or "", text or ""))
    assert {k: [tuple(t) for t in v.turns] for k, v in got.items()} == dict(wanted)
    assert {k: v.valid for k, v in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, None: False}
    assert got[1].loss == control and got[3].loss == "aa" and got[5].loss == ""
    assert chat.format_conversations(df.filter("conv_id < 0")).count() == 0
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- url rules ------------------------------------------------------------------------


def brute_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = [(len(h + p), h.count(".") + 1, h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fitting, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_url_rules_of_nested_hosts_and_odd_urls(spark):
    rng = np.random.default_rng(8)
    names = ["a", "b", "ab", "a-b", "c0"]
    rules = sorted({(["allow", "block"][rng.integers(2)], ".".join(rng.choice(names, rng.integers(1, 5))), ["/", "/x", "/x/y", ""][rng.integers(4)]) for _ in range(60)})
    rules = list({(h, p): (a, h, p) for a, h, p in rules}.values())
    urls = [f"HTTP://{'.'.join(rng.choice(names, rng.integers(1, 7)))}{['', '/', '/x/y/z', '/xx?q#f', '?x', '#/x'][rng.integers(6)]}" for _ in range(400)]
    urls += [None, "", "a.b/x", "x://", "x:///x", "x://a..b/x", "x://A.B:80/x", "x://é.A/x", "x://a.b/x://c/\n", "x://.a/x"]
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)] + [(None, urls[0], "h", 1)] * 2, "page_id long, url string, html string, path int")
    got = url_rules.judge_urls(pages, url_rules.url_rules(spark, rules)).collect()
    assert len(got) == len(pages.collect())
    for row in got:
        assert tuple(row)[1:] == brute_verdict(urls[row.page_id or 0], rules), row
    none = url_rules.judge_urls(pages, url_rules.url_rules(spark, rules).filter("false"), default="block").collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "block")}
    odd = spark.createDataFrame([(None, "a", "/"), ("block", None, "/"), ("block", "", "/"), ("block", "a", None), ("allow", "a", "/"), ("block", "a", "/")], "action string, host string, path string")
    both = url_rules.judge_urls(spark.createDataFrame([(1, "x://a/")], "page_id long, url string"), odd).collect()
    assert (both[0].rule, both[0].verdict) == ("a/", "block")
    assert url_rules.judge_urls(pages.filter("page_id < 0"), odd).count() == 0


# --- pipeline -------------------------------------------------------------------------


def test_pipeline_against_its_stages_by_brute_force(spark):
    """The stages drop what their rules say, and packing holds the ids of what is left."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "n-gram Jaccard join", "packing"]
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train_toxicity(documents, spark.read.parquet(f"{folder}/labels.parquet"))
    texts = {r.doc_id: (r.text, r.lang) for r in documents.collect()}
    toxic = {r.doc_id for r in toxicity.score_toxicity(documents, model).collect() if r.score >= 0.7}
    left = {i: t for i, t in texts.items() if i not in toxic}
    good = brute_verdicts([(i, *t) for i, t in left.items()])
    left = {i: t for i, t in left.items() if good[i][1]}
    sets = {i: shingle_set(t[0]) for i, t in left.items()}
    ids = sorted(sets)
    pairs = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    kept = {i for i, root in brute_components(ids, pairs).items() if i == root}
    assert 0 < len(kept) < len(left) < len(texts)
    library = Tokenizer.from_file(BYTE_BPE)
    wanted = {i: [*library.encode(texts[i][0], add_special_tokens=False).ids, 1] for i in kept}
    check_pieces(corpus_pipeline.run(spark, folder).withColumn("ids_crc32", F.crc32("ids")).collect(), wanted)


def test_stages_keep_columns_and_take_odd_rows(spark):
    for name, stage_of in corpus_pipeline.STAGES[:-1]:
        for docs in (odd_docs(spark), no_docs(spark)):
            out = stage_of(spark, docs, SF_DIR)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    assert len(LONG.split(" ")) == 20_000
