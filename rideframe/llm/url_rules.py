"""URL rules by a sorted sweep over reversed-host keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rideframe.session import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_LABELS = 127
CHAIN_TYPE = "array<struct<size:int,labels:int,rule:string,path:string,action:string>>"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each ended by a dot, so a domain is a prefix of its subdomains."""
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))


def url_rules(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table from (action, host, path) rows."""
    rows = [F.struct(F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path")) for a, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _canonical(rules: DataFrame) -> DataFrame:
    """One row per host and path: key (of the host), depth (labels), path, and the rule as an entry."""
    host = F.translate("host", UPPER, UPPER.lower())
    usable = rules.dropna(subset=["host", "path", "action"]).filter(host != "")
    merged = usable.select(host.alias("host"), "path", "action").groupBy("host", "path").agg(F.max("action").alias("action"))
    labels = F.size(F.split("host", r"\."))
    rule = F.concat("host", "path")
    entry = F.struct(F.length(rule).alias("size"), labels.alias("labels"), rule.alias("rule"), F.col("path"), F.col("action"))
    return merged.select(host_key(F.col("host")).alias("key"), labels.alias("depth"), "path", entry.alias("entry"))


def _chains(rules: DataFrame) -> DataFrame:
    """Each rule with the rules of its host that it is nested in, itself among them: key, path, chain.

    A rule looks up every prefix of its own path, so the work is that of the text of all
    rules, and a chain is as long as the nesting is deep.
    """
    prefixes = rules.select("key", F.col("path").alias("inner"), F.explode(F.sequence(F.lit(0), F.length("path"))).alias("n"))
    prefixes = prefixes.select("key", "inner", F.left("inner", F.col("n")).alias("path"))
    found = prefixes.join(rules.select("key", "path", "entry"), ["key", "path"])
    return found.groupBy("key", F.col("inner").alias("path")).agg(F.collect_list("entry").alias("chain"))


def _rule_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """The keys of all rule hosts that each host lies in: a sweep over hosts and rule hosts in key order.

    A rule host is open from its key on, as long as keys begin with it. The stack has one slot
    per number of labels; a rule host that starts replaces its slot, and a slot counts while its
    key is a prefix of the swept one. Keys are dealt out by range, each range is swept on
    its own, and the slots open at its start come from the ranges before it, of which only
    one row each is gathered.
    """
    depths = [r[0] for r in rules.select("depth").distinct().orderBy("depth").limit(MAX_LABELS + 1).collect()]
    if not depths:
        return hosts.select("host", F.array().cast("array<string>").alias("keys"))
    if len(depths) > MAX_LABELS or depths[-1] > MAX_LABELS:
        raise ValueError(f"a rule's host has more than {MAX_LABELS} labels")
    events = hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "host", F.lit(None).cast("int").alias("depth"))
    starts = rules.select("key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), "depth").distinct()
    ranges = int(hosts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(events.unionByName(starts).repartitionByRange(ranges, "key").withColumn("part", F.spark_partition_id()), "url-sweep")
    names = [f"slot_{d}" for d in depths]
    open_slots = [F.when(F.col("depth") == d, F.col("key")) for d in depths]
    ends = dealt.groupBy("part").agg(*[F.max(s).alias(f"end_{n}") for s, n in zip(open_slots, names)])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", *[F.last(f"end_{n}", ignorenulls=True).over(before).alias(f"from_{n}") for n in names])
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = dealt.select("part", "key", "kind", "host", *[F.last(s, ignorenulls=True).over(sweep).alias(n) for s, n in zip(open_slots, names)])
    swept = swept.filter("kind = 1").join(carried, "part", "left")
    stack = F.array(*[F.coalesce(n, f"from_{n}") for n in names])
    return swept.select("host", F.filter(stack, lambda s: s.isNotNull() & F.startswith(F.col("key"), s)).alias("keys"))


def _last_rules(places: DataFrame, chains: DataFrame) -> DataFrame:
    """For each key and path the last rule at or before it, as its key and chain: a sweep in the order of both.

    All rules whose path a path begins with are in the chain of that one, as whatever lies
    between a prefix and the path begins with the prefix too. Ranges and what is open at
    their start are as in the sweep over hosts.
    """
    asked = places.select("key", "path", F.lit(1).alias("kind"), F.lit(None).cast(CHAIN_TYPE).alias("chain"))
    starts = chains.select("key", "path", F.lit(0).alias("kind"), F.col("chain").cast(CHAIN_TYPE).alias("chain"))
    ranges = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(asked.unionByName(starts).repartitionByRange(ranges, "key", "path").withColumn("part", F.spark_partition_id()), "path-sweep")
    rule = F.when(F.col("kind") == 0, F.struct("key", "path", "chain"))
    ends = dealt.filter("kind = 0").groupBy("part").agg(F.max_by(F.struct("key", "path", "chain"), F.struct("key", "path")).alias("end"))
    # A part without a rule passes on what is open before it: one row per part.
    parts = dealt.select("part").distinct().join(ends, "part", "left")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("part", F.last("end", ignorenulls=True).over(before).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("key", "path", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = dealt.select("part", "key", "path", "kind", F.last(rule, ignorenulls=True).over(sweep).alias("rule")).filter("kind = 1")
    swept = swept.join(F.broadcast(carried), "part", "left").withColumn("rule", F.coalesce("rule", "carried"))
    return swept.filter(F.col("rule.key") == F.col("key")).select("key", "path", F.col("rule.chain").alias("chain"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The verdict on every url by the longest rule that fits.

    ``rules`` has action, host and path. A rule fits its host and all subdomains if the url's
    path starts with the rule's path. The longest ``host + path`` wins, then the host with
    more labels, then the larger text, then ``block``. Returns page_id, host, path, rule,
    verdict for every row; without a rule the verdict is ``default``. A null url, or one
    without ``://``, has an empty host and path, which no rule fits. Rules with a null or an
    empty host are ignored, an empty rule table is allowed, further columns are ignored. A rule
    whose host has more than 127 labels is an error.

    Two sweeps, each over distinct keys: one over hosts finds the rule hosts that a host lies
    in, one over rule hosts and paths finds the rules whose path a path begins with. A row carries
    no more than the rules nested in one another there, however many rules a host has. Each
    distinct host and path is judged once; the join back to pages may be split where it is skewed.
    """
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    canonical = stage(_canonical(rules), "url-rules")
    places = urls.select("host", "path").distinct().join(_rule_hosts(urls.select("host").distinct(), canonical), "host")
    places = stage(places.select("host", "path", F.explode("keys").alias("key")), "url-places")
    ruled = _last_rules(places.select("key", "path").distinct(), _chains(canonical))
    fitting = F.filter("chain", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(F.transform(fitting, lambda r: F.struct(r["size"].alias("size"), r["labels"].alias("labels"), r["rule"].alias("rule"), r["action"].alias("action"))))
    ruled = ruled.withColumn("best", best).filter(F.col("best").isNotNull()).select("key", "path", "best")
    found = places.join(ruled, ["key", "path"]).groupBy("host", "path").agg(F.max("best").alias("best"))
    chosen = urls.join(found, ["host", "path"], "left")
    return chosen.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
