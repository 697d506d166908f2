"""URL filter: rules first, and a ratio of character language models for the rest. Built-in functions only.

Rules name a host and the start of a path; the longest that fits decides. Accepted and rejected URLs, as the rules have
them, train two variable-order Markov models over characters (orders 2, 1 and 0, each smoothed into the next by Witten-Bell
interpolation: unseen contexts fall back to shorter ones). A URL's score is the mean over its characters of
log p(accepted) - log p(rejected); it is blocked below a threshold calibrated on a quarter of the URLs that rules decide, held
out of the training by a hash: the multiple of ``STEP`` at which the shares of accepted URLs below and of rejected ones above it
are least together, or the middle of several such.

Each URL's trigrams are worked out once and written, with its parts, to the shared folder. Characters are mapped to an alphabet of ``SIZE`` symbols, so a model is a table of SIZE ** 3 weights whatever the input: one
array, the value of a scalar subquery, from which each URL adds up its own weights. Pages are not shuffled; only counts by
trigram are, aggregated before.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule, and is judged by the method as
an empty text; a long URL takes work in proportion to its length; without accepted or without rejected URLs, to learn from and to calibrate on, the method allows everything; repeated rows are
judged each and train each; other columns don't matter; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from veriframe.llm.common import ascii_lower_col, saved, table

#: The characters with a symbol of their own, 1 and up; 0 stands for all others, the last but one for the end, the last for the start.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._~/=&%:+"
END, START = len(ALPHABET) + 1, len(ALPHABET) + 2
SIZE = START + 1
STEP, MOST = 0.05, 20.0
#: Rule-decided URLs whose MD5 begins below this hexadecimal digit calibrate; the others teach.
HELD_OUT = "4"

#: (verdict, host and start of path)
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower_col(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def fits(rule: str, host: Column, path: Column) -> Column:
    name, start = rule.split("/", 1)
    return ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)


def first_fit(rules: list[tuple[str, str]], host: Column, path: Column, pick: int) -> Column:
    """What the longest fitting rule has: pick 0 its verdict, 1 the rule itself; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1])):
        found = F.when(fits(rule[1], host, path), F.lit(rule[pick])).otherwise(found)
    return found


def trigrams(host: Column, path: Column) -> Column:
    """The text's symbols, each with the two before it, as one number: (a * SIZE + b) * SIZE + c."""
    text = F.concat(host, ascii_lower_col(path))
    letters = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "", -1))
    symbols = F.concat(F.array(F.lit(START), F.lit(START)), F.transform(F.filter(letters, lambda x: x != ""), lambda x: F.call_function("locate", x, F.lit(ALPHABET))), F.array(F.lit(END)))
    part = lambda k, name: F.slice(symbols, k, F.size(symbols) - 2).alias(name)
    # the symbols beside themselves shifted: looked up one by one, they would be worked out again for each character
    return F.transform(F.arrays_zip(part(1, "a"), part(2, "b"), part(3, "c")), lambda x: (x["a"] * SIZE + x["b"]) * SIZE + x["c"])


def weights(counts: DataFrame, accepted: int, rejected: int) -> DataFrame:
    """(gram, weight) for all SIZE ** 3 trigrams, from (gram, accepted, rejected) counts and their sums."""
    all_grams = counts.sparkSession.range(SIZE**3).select(F.col("id").cast("int").alias("gram"))
    grid = all_grams.join(counts, "gram", "left").select(
        "gram",
        F.floor(F.col("gram") / (SIZE * SIZE)).alias("a"),
        (F.floor(F.col("gram") / SIZE) % SIZE).alias("b"),
        (F.col("gram") % SIZE).alias("c"),
        *(F.coalesce(x, F.lit(0)).cast("double").alias(x) for x in ("accepted", "rejected")),
    )
    over = W.Window.partitionBy
    out = grid
    logs = {}
    for kind, total in (("accepted", accepted), ("rejected", rejected)):
        n = F.col(kind)
        out = out.withColumns({f"{kind}_bc": F.sum(n).over(over("b", "c")), f"{kind}_c": F.sum(n).over(over("c")), f"{kind}_ab": F.sum(n).over(over("a", "b")), f"{kind}_ab_kinds": F.sum((n > 0).cast("double")).over(over("a", "b"))})
        one_a = F.when(F.col("a") == 0, F.col(f"{kind}_bc"))
        out = out.withColumns({f"{kind}_b": F.sum(one_a).over(over("b")), f"{kind}_b_kinds": F.sum((one_a > 0).cast("double")).over(over("b"))})
        x = {name: F.col(f"{kind}_{name}") for name in ("bc", "c", "ab", "ab_kinds", "b", "b_kinds")}
        p = (x["c"] + 1) / F.lit(float(total + SIZE))
        p = F.when(x["b"] > 0, (x["bc"] + x["b_kinds"] * p) / (x["b"] + x["b_kinds"])).otherwise(p)
        p = F.when(x["ab"] > 0, (n + x["ab_kinds"] * p) / (x["ab"] + x["ab_kinds"])).otherwise(p)
        logs[kind] = F.log(p)
    return out.select("gram", (logs["accepted"] - logs["rejected"]).alias("weight"))


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, score, verdict) of each row of pages."""
    host, path = F.col("host"), F.col("path")
    split = pages.select(F.col(id_col).alias("__id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    held_out = F.substring(F.md5(F.concat(host, path).cast("binary")), 1, 1) < HELD_OUT
    parts = saved(split.select("*", first_fit(rules, host, path, 1).alias("rule"), first_fit(rules, host, path, 0).alias("known"), held_out.alias("held_out"), trigrams(host, path).alias("grams")))
    is_a = lambda v: (F.col("known") == v).cast("int")
    teach = parts.where("known is not null and not held_out")
    counts = saved(teach.select(is_a("allow").alias("a"), is_a("block").alias("r"), F.explode("grams").alias("gram")).groupBy("gram").agg(F.sum("a").alias("accepted"), F.sum("r").alias("rejected")))
    accepted, rejected = counts.agg(F.sum("accepted"), F.sum("rejected")).first()
    method, score = F.lit("allow"), F.lit(None).cast(T.DoubleType())
    if accepted and rejected:
        table_ = saved(weights(counts, accepted, rejected))  # SIZE ** 3 rows
        model = table_.agg(F.transform(F.array_sort(F.collect_list(F.struct("gram", "weight"))), lambda x: x["weight"])).scalar()
        parts = parts.withColumn("model", model)
        score = F.aggregate("grams", F.lit(0.0), lambda s, g: s + F.get("model", g)) / F.size("grams")
        edge = F.floor(F.greatest(F.least(score, F.lit(MOST)), F.lit(-MOST)) / STEP).cast("int")
        bins = parts.where("known is not null and held_out").groupBy(edge.alias("bin")).agg(F.sum(is_a("allow")).alias("a"), F.sum(is_a("block")).alias("r")).collect()  # at most 2 * MOST / STEP + 1 rows
        method = F.when(score < F.lit(threshold(bins)), "block").otherwise("allow")
    return parts.select(F.col("__id").alias(id_col), "host", "path", "rule", score.alias("score"), F.coalesce("known", method).alias("verdict"))


def threshold(bins: list) -> float:
    """The multiple of STEP at which the share of accepted URLs below and that of rejected ones above it are least together; of several
    such, the one in the middle. Without URLs of either kind: below all."""
    by_bin = {b.bin: (b.a, b.r) for b in bins}
    accepted, rejected = sum(a for a, _ in by_bin.values()), sum(r for _, r in by_bin.values())
    if not accepted or not rejected:
        return -MOST
    good = bad = 0
    lost: dict[int, int] = {}  # edge -> accepted below and rejected not below, over a common denominator
    for edge in range(min(by_bin), max(by_bin) + 2):
        lost[edge] = good * rejected + (rejected - bad) * accepted
        good, bad = (x + y for x, y in zip((good, bad), by_bin.get(edge, (0, 0)), strict=True))
    best = [edge for edge, x in lost.items() if x == min(lost.values())]
    return (best[0] + best[-1]) // 2 * STEP


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).drop("score")


def oracle(rules: list[tuple[str, str]] = RULES) -> str:
    cases = {1: [], 0: []}
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, start = rule.split("/", 1)
        when = f"when (host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '/{start}') then "
        cases[1].append(f"{when}'{rule}'")
        cases[0].append(f"{when}'{verdict}'")
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def smoothed(n: str) -> str:
        one = f"(({n}_c + 1.0) / (select sum({n}) + {SIZE} from gram_count))"
        two = f"(case when {n}_b > 0 then ({n}_bc + {n}_bk * {one}) / ({n}_b + {n}_bk) else {one} end)"
        return f"ln(case when {n}_ab > 0 then ({n} + {n}_abk * {two}) / ({n}_ab + {n}_abk) else {two} end)"

    wide = ", ".join(f"sum({n}) over (partition by b, c) {n}_bc, sum({n}) over (partition by c) {n}_c, sum({n}) over (partition by a, b) {n}_ab, count(*) filter ({n} > 0) over (partition by a, b) {n}_abk" for n in ("x", "y"))
    wider = ", ".join(f"sum({n}_bc) filter (a = 0) over (partition by b) {n}_b, count(*) filter (a = 0 and {n}_bc > 0) over (partition by b) {n}_bk" for n in ("x", "y"))
    return rf"""
with recursive split as (select page_id, row_number() over () id, {lower.format("coalesce(regexp_extract(url, '" + PARTS + "', 1), '')")} host, coalesce(regexp_extract(url, '{PARTS}', 2), '') path from pages),
ruled as (select *, case {" ".join(cases[1])} end rule, case {" ".join(cases[0])} end known, host || {lower.format("path")} t, substring(md5(host || path), 1, 1) < '{HELD_OUT}' held_out from split),
coded as (select *, [{START}, {START}] || list_transform(range(1, length(t) + 1), lambda i: instr('{ALPHABET}', substring(t, i, 1))) || [{END}] s from ruled),
gram as (select id, known, held_out, unnest(list_transform(range(1, len(s) - 1), lambda i: (s[i] * {SIZE} + s[i + 1]) * {SIZE} + s[i + 2])) g from coded),
gram_count as (select g, count(*) filter (known = 'allow') x, count(*) filter (known = 'block') y from gram where known is not null and not held_out group by g),
grid as (select r.g, r.g // {SIZE * SIZE} a, (r.g // {SIZE}) % {SIZE} b, r.g % {SIZE} c, coalesce(x, 0)::double x, coalesce(y, 0)::double y from (select range g from range({SIZE**3})) r left join gram_count using (g)),
wide as (select *, {wide} from grid), wider as (select *, {wider} from wide),
model as (select g, {smoothed("x")} - {smoothed("y")} w from wider),
scored as (select id, avg(w) score from gram join model using (g) group by id),
known as (select known, floor(greatest(least(score, {MOST}), -{MOST}) / {STEP})::int bin from scored join ruled using (id) where known is not null and held_out),
bins as (select bin, count(*) filter (known = 'allow') a, count(*) filter (known = 'block') r from known group by bin),
edges as (select unnest(range((select min(bin) from bins), (select max(bin) + 2 from bins))) edge),
lost as (select edge, coalesce((select sum(a) from bins where bin < edge), 0) * (select sum(r) from bins) + coalesce((select sum(r) from bins where bin >= edge), 0) * (select sum(a) from bins) wrong from edges),
cut as (select case when (select sum(a) from bins) > 0 and (select sum(r) from bins) > 0 then floor((min(edge) + max(edge)) / 2.0) * {STEP}::double else -{MOST}::double end edge from lost where wrong = (select min(wrong) from lost)),
trained as (select count(*) filter (x > 0) > 0 and count(*) filter (y > 0) > 0 ok from gram_count)
select page_id, host, path, rule, coalesce(known, case when (select ok from trained) and score < (select edge from cut) then 'block' else 'allow' end) verdict
from ruled left join scored using (id)
"""
