"""Fill-in-middle forms, scaled sketches and centroid clusters against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rideframe.llm import chosen_path, fill_middle, pivot_rings, pq_dedup, scaled_sketch, url_rules, vantage_clusters
from rideframe.llm.queries import QUERIES
from tests.llm.data import LONG, ODD_TEXTS, SF_DIR, no_docs, odd_docs
from tests.llm.test_operators import check_documents, check_vectors

# --- fill in the middle ---------------------------------------------------------------

MARKED = "text with <S> in it\nand more\n"
MULTI = "naïve\nüber 日本語\n\n👍🏽 end\r\nlast é"


def brute_form(doc_id, text, seed, unit, rate, spm):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, None, None, text
    sizes = len(prefix), len(middle), len(prefix.encode()), len(middle.encode())
    if h4 % 100 < spm:
        return n, "spm", *sizes, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", *sizes, f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(st.lists(st.text(alphabet="ab\n é日👍", max_size=12), max_size=6))
@settings(max_examples=60, deadline=None)
def test_index_converts_every_cut(texts):
    data, ends = fill_middle._block(pa.array(["skipped é", *texts], pa.string()).slice(1))
    index = fill_middle.ExceptionIndex(data)
    whole = "".join(texts)
    at = np.arange(len(whole) + 1)
    byte = np.array([len(whole[:k].encode()) for k in at])
    assert index.bytes(at).tolist() == byte.tolist() and index.chars(byte).tolist() == at.tolist()
    assert len(index.byte_at) == sum(c > "\x7f" for c in whole)
    assert ends.tolist() == [0, *np.cumsum([len(t.encode()) for t in texts]).tolist()]


@pytest.mark.parametrize("unit,rate,spm", [("line", 100, 50), ("char", 100, 50), ("line", 40, 100), ("char", 60, 0)])
def test_fill_middle_by_brute_force(spark, unit, rate, spm):
    texts = [*ODD_TEXTS, MARKED, MULTI, "\n", "\n\n", "é", "no break", "a\nb"] * 3
    rows = [*enumerate(texts), (None, MULTI), (1, "repeated\nrow"), (1, "repeated\nrow")]
    docs = spark.createDataFrame([(i, t, "f", "o") for i, t in rows], "doc_id long, text string, form string, output string")
    made = fill_middle.fill_in_middle(docs, 7, unit, rate, spm)
    got = made.withColumn("back", fill_middle.restore_text(F.col("output"), F.col("form"))).collect()
    wanted = sorted(map(repr, [(i, *brute_form(i, t, 7, unit, rate, spm), t or "") for i, t in rows]))
    assert sorted(repr(tuple(r)) for r in got) == wanted
    assert {r.form for r in got} == ({"plain", "spm", "psm"} if 0 < spm < 100 else {"plain", "spm" if spm else "psm"})


def test_fill_middle_query(spark):
    import duckdb

    texts = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_fill_middle"](spark, SF_DIR).collect()}
    for doc, text in texts:
        n, form, chars, middle, _, _, output = brute_form(doc, text, 7, "line", 100, 50)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (output, text or "")]
        assert got[doc] == (n, form, chars, middle, *digests)


def test_fill_middle_of_odd_tables(spark):
    assert fill_middle.fill_in_middle(no_docs(spark)).count() == 0
    assert fill_middle.fill_in_middle(odd_docs(spark)).count() == len(ODD_TEXTS) + 2
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(odd_docs(spark), unit="word")


@pytest.mark.parametrize("markers", [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<a", "a>", "<M>"), ("<P>", "x<P>y", "<M>"), ("aa", "<S>", "<M>")])
def test_markers_that_could_be_mistaken_are_refused(markers):
    with pytest.raises(ValueError):
        fill_middle.Markers(*markers)


# --- scaled sketches ------------------------------------------------------------------


def brute_sketch(text, scale=scaled_sketch.SCALE):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashes = {hashlib.md5(" ".join(words[i : i + 5]).encode()).hexdigest()[:16] for i in range(max(1, len(words) - 4))} if words else set()
    low = {h for h in hashes if int(h, 16) < (1 << 64) // scale}
    return sorted(low or set(sorted(hashes)[:1]))


def brute_likeness(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def check_fingerprints(rows, docs):
    """``docs`` has distinct (id, text) pairs; ids may be null and may repeat."""
    from collections import Counter

    by_id = {}
    for i, t in docs:
        by_id.setdefault(i, []).append(t or "")
    wanted = {}
    # The order of texts under one id is that of a hash, so only single ones have a known neighbour.
    ids = sorted((i for i in by_id if i is not None), reverse=True) + ([None] if None in by_id else [])
    for n, i in enumerate(ids):
        after = ids[(n + 1) % len(ids)]
        if len(by_id[i]) > 1 or len(by_id[after]) > 1:
            continue
        text, other = by_id[i][0], by_id[after][0]
        k = len(text) // 3
        edited = text[: len(text) - k] + other[:k]
        own, new, next_own = brute_sketch(text), brute_sketch(edited), brute_sketch(other)
        holds = len(set(own) & set(new)) / len(own) if own else 1.0
        wanted[i] = (len(text), edited, own, new, next_own, brute_likeness(own, new), brute_likeness(own, next_own), holds)
    got = {r.doc_id: tuple(r)[1:] for r in rows}
    assert wanted and {i: got[i] for i in wanted} == wanted
    return Counter(r.doc_id for r in rows)


def test_fingerprints_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in enumerate(ODD_TEXTS)] + [(None, "some text of no id", "a", 1), (6, ODD_TEXTS[6], "b", 2)], "doc_id long, text string, tie string, known int")
    counts = check_fingerprints(scaled_sketch.fingerprint_documents(docs).collect(), [*enumerate(ODD_TEXTS), (None, "some text of no id")])
    assert counts[6] == 2 and counts[None] == 1 and sum(counts.values()) == len(ODD_TEXTS) + 2
    assert scaled_sketch.fingerprint_documents(no_docs(spark)).count() == 0
    [only] = scaled_sketch.fingerprint_documents(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).collect()
    assert (only.edited, only.near_next) == ("abcdab", 1.0)


def test_fingerprints_of_a_repeated_id(spark):
    """Texts of one id follow one another in one cycle with all others, and equal rows are one document."""
    docs = [(5, f"text number {i} of five words and more") for i in range(7)] + [(9, "the largest id of all these rows"), (1, "the smallest id of all these rows")]
    df = spark.createDataFrame(docs * 2, "doc_id long, text string")
    rows = scaled_sketch.fingerprint_documents(df).collect()
    assert len(rows) == 18
    nexts = {(r.doc_id, tuple(r.sketch)): tuple(r.next_sketch) for r in rows}
    assert len(nexts) == 9 and sorted(nexts.values()) == sorted(s for _, s in nexts)
    assert nexts[(1, tuple(brute_sketch(docs[-1][1])))] == tuple(brute_sketch(docs[-2][1]))


def test_fingerprint_query_and_plan(spark):
    import duckdb

    texts = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    check_fingerprints(scaled_sketch.fingerprint_documents(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect(), texts)
    df = QUERIES["op12_scaled_sketch"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
    rows = df.collect()
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next, r.edited_holds))
    # Texts of some length are much more like their edited form than like their neighbour.
    pairs = [(r.near_edited, r.near_next) for r in rows if r.n_chars > 600]
    assert np.mean([a > b for a, b in pairs]) > 0.95


def test_sketches_merge_and_contain(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(4000)]
    long = " ".join(rng.choice(words, 6000))
    part = " ".join(long.split(" ")[2000:2400])
    other = " ".join(rng.choice(words, 400))
    df = spark.createDataFrame([(long, part, other, long + " " + other)], "long string, part string, other string, whole string")
    for name in df.columns:
        df = scaled_sketch.with_sketch(df, name, f"{name}_s")
    a, b, c = (F.col(f"{n}_s") for n in ("long", "part", "other"))
    row = df.select(
        scaled_sketch.containment(b, a).alias("inside"), scaled_sketch.containment(c, a).alias("outside"), scaled_sketch.likeness(b, a).alias("like"),
        scaled_sketch.merge_sketches(a, c).alias("merged"), "whole_s", "long_s", scaled_sketch.read_fingerprint(scaled_sketch.fingerprint(a)).alias("back"),
        scaled_sketch.read_fingerprint(F.lit("")).alias("nothing"),
    ).first()
    assert row.inside == 1.0 and row.outside == 0.0 and 0.02 < row.like < 0.15
    assert set(row.merged) <= set(row.whole_s) and len(set(row.whole_s) - set(row.merged)) <= 4  # shingles across the seam
    assert row.back == row.long_s == brute_sketch(long) and row.nothing == []
    sizes = spark.createDataFrame([(LONG,)], "text string")
    for scale in (1, 2, 64, 1 << 16):
        [sketched] = scaled_sketch.with_sketch(sizes, "text", "s", scale).collect()
        assert sketched.s == brute_sketch(LONG, scale)
    with pytest.raises(ValueError):
        scaled_sketch.ceiling(3)


# --- clusters -------------------------------------------------------------------------


def brute_clusters(vectors, k, rounds, seed, d, scale=256):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in vectors if v is not None and len(v) == d and all(x is not None and abs(x) < (1 << 24) / scale for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == n]
            if own:
                centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    sums = {n: sum(x for x, c in found if c == n) for n in range(k)}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((repr(i), c, x, sums[c], sum(sums.values()), digests[c]) for (i, _), (x, c) in zip(kept, found))


def check_clusters(spark, vectors, k, rounds=5, d=4):
    df = spark.createDataFrame([(i, v, "c", 3) for i, v in vectors], "vec_id long, embedding array<double>, label string, cluster int")
    rows = vantage_clusters.cluster_vectors(df, k=k, rounds=rounds, dimensions=d).collect()
    assert sorted((repr(r[0]), *tuple(r)[1:]) for r in rows) == brute_clusters(vectors, k, rounds, 2, d)
    return rows


def test_tree_finds_the_smallest_of_equal_centroids():
    rng = np.random.default_rng(3)
    for d, spread, k in ((2, 3, 40), (3, 4, 25), (8, 100, 64), (1, 5, 30), (2, 1, 9), (64, 2000, 40)):
        centroids = rng.integers(-spread, spread + 1, (k, d))
        vectors = rng.integers(-spread - 2, spread + 3, (700, d))
        tree = vantage_clusters.build_tree(centroids)
        number, distance, taken = vantage_clusters.nearest(vectors, tree)
        whole = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert number.tolist() == whole.argmin(axis=1).tolist() and distance.tolist() == whole.min(axis=1).tolist()
        members = [int(c) for leaf in tree.leaves for c in leaf] + [int(v) for v in tree.vantage if v >= 0]
        assert sorted(members) == list(range(k))
        if d == 2 and spread == 3:
            assert taken < 0.8 * whole.size  # the tree does pass centroids over


def test_clusters_with_a_hot_group_ties_and_odd_rows(spark):
    rng = np.random.default_rng(9)
    vectors = [(i, rng.normal(0, 0.02, 4).round(2).tolist()) for i in range(150)]
    vectors += [(1000 + i, [0.5, -0.25, 0.0, 1.0]) for i in range(100)] + [(3, vectors[3][1]), (3, [9.0, 9.0, 9.0, 9.0])]
    vectors += [(2000, None), (2001, []), (2002, [1.0, 2.0, 3.0]), (2003, [1.0, None, 2.0, 3.0]), (2004, [float("nan"), 0.0, 0.0, 0.0]), (2005, [float("inf"), 0.0, 0.0, 0.0])]
    vectors += [(None, [0.1, 0.1, 0.1, 0.1]), (2006, [-1e300, 0.0, 0.0, 0.0]), (2007, [-300.5, 40_000.25, 1e-300, -0.001])]
    rows = check_clusters(spark, vectors, k=12)
    assert len(rows) == 150 + 100 + 2 + 2
    check_clusters(spark, vectors[:5], k=12)
    check_clusters(spark, vectors[:60], k=1, rounds=2)
    check_clusters(spark, vectors[100:200], k=7, rounds=0)


def test_clusters_of_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    found = vantage_clusters.cluster_vectors(none)
    assert found.count() == 0
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert vantage_clusters.cluster_vectors(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")).count() == 0
    with pytest.raises(ValueError):
        vantage_clusters.cluster_vectors(none, k=0)


# --- dense buckets of near copies -----------------------------------------------------


def near_copies(n, length=120, edits=4, seed=4):
    rng = np.random.default_rng(seed)
    base = [f"t{i}" for i in range(length)]
    texts = []
    for i in range(n):
        words = list(base)
        for k in rng.integers(0, length, rng.integers(0, edits)):
            words[k] = f"u{rng.integers(0, 40)}"
        texts.append((i, " ".join(words)))
    return texts


@pytest.mark.parametrize("edits,bucket", [(2, 16), (4, 16), (9, 16), (14, 8)])
def test_dense_buckets_by_brute_force(spark, monkeypatch, edits, bucket):
    """Light, middling and heavy edits: proven, undecided and far pairs, with copies and two bases."""
    monkeypatch.setattr(chosen_path, "BUCKET", bucket)
    monkeypatch.setattr(pivot_rings, "BLOCK", 8)
    monkeypatch.setattr(pivot_rings, "RING_TOKENS", 256)
    texts = near_copies(150, edits=edits) + [(1000 + i, t.replace("t5", "z5")) for i, t in near_copies(60, 60, 3, 5)]
    texts += [(200 + i, texts[i][1]) for i in range(10)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check_documents(chosen_path.similar_documents(docs).collect(), texts)


@given(st.integers(0, 10**6), st.integers(1, 12), st.sampled_from([0.8, 0.85, 0.9]))
@settings(max_examples=40, deadline=None)
def test_costs_decide_like_jaccard(seed, spread, similarity):
    """The two costs and the shared tokens of the differences give the comparison of the whole sets."""
    rng = np.random.default_rng(seed)
    pivot = np.unique(rng.integers(0, 80, 40))
    sets = [np.unique(np.concatenate([rng.choice(pivot, max(1, len(pivot) - rng.integers(0, spread))), rng.integers(60, 90, rng.integers(0, spread))])) for _ in range(12)]
    sets.append(pivot)
    costs, diffs = [], []
    for own in sets:
        removed, added, diff = pivot_rings.difference(pivot, own)
        costs.append(round(pivot_rings.UNIT * (removed + similarity * added - (1 - similarity) * len(pivot) / 2)))
        diffs.append(set(diff.tolist()))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            shared = len(np.intersect1d(a, b))
            wanted = shared >= similarity * (len(a) + len(b) - shared) - 1e-6
            total = costs[i] + costs[j]
            assert wanted == (total <= pivot_rings._each_shared(similarity) * len(diffs[i] & diffs[j]) + pivot_rings.TOLERANCE)
            if total <= pivot_rings.TOLERANCE:
                assert wanted


def test_rows_of_a_dense_group_follow_its_size(spark, monkeypatch):
    """A group of 37 blocks: every table between the steps has some rows per document, not one per block."""
    written = {}
    plain = chosen_path.stage

    def counted(df, name):
        out = plain(df, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    for module in (chosen_path, pivot_rings):
        monkeypatch.setattr(module, "stage", counted)
    monkeypatch.setattr(chosen_path, "BUCKET", 32)
    n = 1200
    docs = spark.createDataFrame(near_copies(n, edits=4), "doc_id long, text string")
    assert chosen_path.similar_documents(docs).filter("n_links > 0").count() > n // 2
    assert {"differences", "group-members", "ring-blocks"} <= set(written)
    assert max(written.values()) <= 30 * n, written
    assert written["group-members"] <= 10 * n and written["ring-blocks"] <= n // 32, written


def test_texts_of_one_id_are_linked_on_their_own(spark):
    a, b = near_copies(1)[0][1], " ".join(f"q{i}" for i in range(90))
    rows = [(5, a), (5, b), (6, a + " tail"), (7, b + " tail"), (7, b + " tail"), (8, "a text that is like no other one here")]
    docs = spark.createDataFrame([(i, t, 0, 1) for i, t in rows], "doc_id long, text string, dropped_id int, text_key int")
    got = sorted((r.doc_id, r.n_links, r.group_id, r.kept) for r in chosen_path.similar_documents(docs).collect())
    assert got == [(5, 1, 5, True), (5, 2, 5, True), (6, 1, 5, False), (7, 2, 5, False), (7, 2, 5, False), (8, 0, 8, True)]
    kept = chosen_path.drop_near_copies(docs.unionAll(spark.createDataFrame([(7, "and a text of its own under a known id", 0, 1)], docs.schema)))
    assert sorted((r.doc_id, r.text[:2]) for r in kept.collect()) == [(5, "q0"), (5, "t0"), (7, "an"), (8, "a ")] and kept.columns == docs.columns


# --- vectors and url rules ------------------------------------------------------------


def test_vectors_of_every_length_and_of_one_id(spark):
    rng = np.random.default_rng(12)
    vectors = [(i, (np.ones(5) + rng.normal(0, 0.1, 5)).tolist(), 0) for i in range(40)]
    vectors += [(100, [1.0, 2.0], 0), (101, [1.0, 2.001], 0), (102, [1.0, 2.0, 0.0], 0), (103, [1.0], 0), (104, [3.0], 0), (105, [-1.0], 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    check_vectors(pq_dedup.near_duplicate_vectors(df).collect(), vectors)
    twice = spark.createDataFrame([(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 0.01]), (7, [0.01, 1.0]), (7, [0.01, 1.0])], "vec_id long, embedding array<float>").withColumn("label", F.lit("x"))
    got = sorted(tuple(r) for r in pq_dedup.near_duplicate_vectors(twice).collect())
    assert got == [(5, 1, 5, True), (5, 2, 5, True), (6, 1, 5, False), (7, 2, 5, False), (7, 2, 5, False)]


def test_lists_grow_and_recall_of_clusters(spark, monkeypatch):
    """Many clusters of near vectors in 64 dimensions: nearly all links found with few probes, all without a limit."""
    assert [pq_dedup.lists_for(n) for n in (1, 1000, 51_282, 10**6, 10**12)] == [8, 16, 128, 512, 4096]
    assert pq_dedup.reach_for(0.2, 9, 4.0) == 0.2 == pq_dedup.reach_for(0.2, 64, None) and abs(pq_dedup.reach_for(0.2, 64, 4.0) - 0.1) < 1e-12
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 1, (40, 64))
    vectors = [(i, (centres[i % 40] + rng.normal(0, 0.125, 64)).tolist(), 0) for i in range(400)]
    unit = np.array([v for _, v, _ in vectors])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    wanted = int((unit @ unit.T >= 0.98).sum()) - 400
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    placed = {}
    plain = pq_dedup.stage

    def counted(df, name):
        out = plain(df, name)
        if name == "vector-index":
            placed["probes"] = out.select(F.sum(F.size("probes"))).first()[0]
        return out

    monkeypatch.setattr(pq_dedup, "stage", counted)
    found = pq_dedup.near_duplicate_vectors(df).agg(F.sum("n_links")).first()[0]
    assert wanted > 500 and 0.999 * wanted <= found <= wanted and placed["probes"] < 7 * 400
    check_vectors(pq_dedup.near_duplicate_vectors(df, deviations=None).collect(), vectors)


def test_very_many_path_rules_of_one_host(spark):
    """A hundred thousand rules of one host, nested ones among them; rows hold what is nested, not all."""
    rng = np.random.default_rng(2)
    rules = [("block" if i % 3 else "allow", "big.com", f"/s{i}/") for i in range(100_000)]
    rules += [("allow", "big.com", f"/s{i}/a"[: 3 + i % 5]) for i in range(0, 400, 7)] + [("block", "big.com", "/s7/a/b/c"), ("allow", "com", "/s1"), ("block", "www.big.com", "/s12/")]
    rules = list({(h, p): (a, h, p) for a, h, p in rules}.values())
    table = spark.createDataFrame(rules, "action string, host string, path string")
    urls = [f"x://{['big.com', 'www.big.com', 'a.www.big.com', 'other.com'][rng.integers(4)]}/s{rng.integers(120_000)}{['', '/', '/a/b/c/d'][rng.integers(3)]}" for _ in range(500)]
    urls += ["x://big.com/s7/a/b/cd", "x://www.big.com/s12/", "x://big.com/s1", "x://com/s1x"]
    pages = spark.createDataFrame([*enumerate(urls)], "page_id long, url string")
    by_path = {}
    for a, h, p in rules:
        by_path.setdefault((h, p), a)
    got = url_rules.judge_urls(pages, table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
    for row in got.collect():
        host, path = re.match(r"x://([^/]*)(.*)", urls[row.page_id]).groups()
        labels = host.split(".")
        fitting = [(len(h + p), h.count("."), h + p, by_path[h, p]) for k in range(len(labels)) for h in [".".join(labels[k:])] for n in range(len(path) + 1) for p in [path[:n]] if (h, p) in by_path]
        best = max(fitting, default=None)
        assert (row.rule, row.verdict) == ((best[2], best[3]) if best else (None, "allow")), (row, best)
