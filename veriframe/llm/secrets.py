"""Secret scans with linking of multipart credentials. Built-in functions only.

Three strong patterns give the base findings: assignments to a secret's name, access identifiers and long hexadecimal runs.
Weak parts are no findings by themselves: *identifiers* (access ids too short for the base), *secrets* (long mixed runs of
letters and digits) and *endpoints* (host names after ``://`` or ``@``). They are linked by an interval join: each part is filed
under the cells of ``SCOPE`` characters that it begins in, and the neighbouring cells; parts of one document that meet in a
cell and lie within ``SCOPE`` of each other complement one another if their kinds differ. A weak secret is reported if an
identifier (weak or strong) or an endpoint is in its scope, a weak identifier if a secret (weak or strong) is.

Where something is, is worked out from the pieces between the matches: `split` gives the pieces, `regexp_extract_all` the matches;
their lengths become one row a match, and a running sum over a document's rows of one kind gives the places, in code points.
Whether a weak part overlaps a strong one is told by two more running windows. So the work on a text grows with its length and, but
for sorting, its number of matches. No pattern repeats a group, which Java's matcher would do by recursion. Texts without any
candidate stay where they are; of the others only numbers are shuffled, and they are written once to the shared folder.
The join asks only whether a partner exists (partners are reduced to the first and the last one per document, cell and kind).

Defined cases: a null or empty text has no findings; repeated rows get the same findings each; weak spans that overlap a base
span are left out; a null id is an id like others; ids may be of any type; extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veriframe.llm.common import saved, table

SCOPE = 200


def either(word: str) -> str:
    """A pattern for the word with letters in either case (A-Z only)."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


NAMES = "|".join([*map(either, ("password", "passwd", "secret", "token")), f"{either('api')}_?{either('key')}"])
#: Base kinds in their order: (kind, pattern, group whose length counts, least length of it).
BASE = [
    ("assign", rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
#: The same matches, found faster: shorter runs can't contain or hide a long one.
FASTER = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
#: Weak kinds: (kind, pattern). Lengths below those of the base.
WEAK = [
    ("weak_id", r"AKIA[A-Z0-9]{8,}"),
    ("weak_secret", r"[A-Za-z0-9+/]{32,}"),
    ("endpoint", r"(?:://|@)[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9-]"),
]
KINDS = [b[0] for b in BASE]
#: Texts that this doesn't match have neither base findings nor weak parts that could be reported.
ANY = "|".join([rf"""(?:{NAMES})["']?\x20*[:=]""", "AKIA[A-Z0-9]{8}", "[0-9a-f]{24}", "[A-Za-z0-9+/]{32}"])
#: Weak parts are looked for in texts that this matches; endpoints alone are of no use.
HAS_WEAK = "AKIA[A-Z0-9]{8}|[A-Za-z0-9+/]{32}"
PIECE = "array<struct<gap:int,size:int,counted:int>>"


def pieces(text: Column, kind: str, pattern: str, group: int = 0, within: str | None = None) -> Column:
    """array<struct<kind, gap, size, counted>>: of each match, the lengths of what stands before it, of itself and of its group; a
    last element without size. Each array is worked out once a text, outside of lambdas, and zipped."""
    lengths = lambda x: F.transform(x, lambda y: F.length(y))
    gap, size = lengths(F.split(text, pattern, -1)), lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    counted = lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))) if group else F.array().cast("array<int>")
    found = F.when(text.rlike(within or pattern), F.arrays_zip(gap, size, counted).cast(PIECE)).otherwise(F.array().cast(PIECE))
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["gap"].alias("gap"), x["size"].alias("size"), x["counted"].alias("counted")))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __text, __digest of the text)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("__id"), text.alias("__text"), F.xxhash64(text).alias("__digest"))


def placed(docs: DataFrame) -> DataFrame:
    """(__id, __digest, kind, s, e) of the base findings, and of the weak parts clear of them, of `keyed` rows."""
    text = F.col("__text")
    kinds = [pieces(text, kind, FASTER.get(kind, pattern), 0 if kind in FASTER else group) for kind, pattern, group, _ in BASE]
    kinds += [pieces(text, kind, pattern, within=HAS_WEAK) for kind, pattern in WEAK]
    rows = docs.where(text.rlike(ANY)).select("__id", "__digest", F.posexplode(F.flatten(F.array(*kinds))).alias("at", "x"))
    rows = rows.select("__id", "__digest", "at", "x.*").where("size is not null").distinct()  # repeated rows once
    so_far = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("__id", "__digest", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    least = {kind: n for kind, _, _, n in BASE if kind not in FASTER}
    enough = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in least.items() for x in pair)), F.col("kind")) <= F.col("counted"), F.lit(True))
    spans = rows.withColumn("e", so_far.cast("int")).where(enough).select("__id", "__digest", "kind", (F.col("e") - F.col("size")).alias("s"), "e")
    base, one = F.col("kind").isin(KINDS), Window.partitionBy("__id", "__digest")
    before = F.max(F.when(base, F.col("e"))).over(one.orderBy("s").rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(base, F.col("s"))).over(one.orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, 0))
    spans = spans.withColumns({"before": before, "after": after})
    clear = F.coalesce(F.col("before") <= F.col("s"), F.lit(True)) & F.coalesce(F.col("after") >= F.col("e"), F.lit(True))
    return spans.where(base | clear).drop("before", "after")


def tagged(kind: str, found: Column) -> Column:
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind")))


def linked(parts: DataFrame, *, scope: int = SCOPE) -> DataFrame:
    """The weak secrets and identifiers among (__id, __digest, kind, s, e) that a complementary part is near."""
    role = F.when(F.col("kind").isin("access", "weak_id"), "identifier").when(F.col("kind").isin("assign", "hex", "weak_secret"), "secret").otherwise("endpoint")
    parts = parts.withColumn("role", role)
    cell = F.floor(F.col("s") / scope)
    # partners by cell: of each role the first and the last start are enough to know whether one is in scope
    near = parts.select(F.col("__id").alias("id"), F.col("__digest").alias("digest"), F.col("role").alias("with"), "s", cell.alias("own"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("near_cell"))
    near = near.groupBy("id", "digest", "with", "near_cell").agg(
        F.min(F.when(F.col("own") > F.col("near_cell"), F.col("s"))).alias("min_after"),
        F.min(F.when(F.col("own") == F.col("near_cell"), F.col("s"))).alias("min_same"),
        F.max(F.when(F.col("own") < F.col("near_cell"), F.col("s"))).alias("max_before"),
    )
    wanted = F.when(F.col("role") == "identifier", F.array(F.lit("secret"))).otherwise(F.array(F.lit("identifier"), F.lit("endpoint")))
    asking = parts.where(F.col("kind").isin("weak_id", "weak_secret")).withColumns({"cell": cell, "wanted": F.explode(wanted)})
    in_scope = F.col("min_same").isNotNull() | (F.col("min_after") - F.col("asking.s") <= scope) | (F.col("asking.s") - F.col("max_before") <= scope)
    keys = F.col("__id").eqNullSafe(F.col("id")) & (F.col("__digest") == F.col("digest")) & (F.col("wanted") == F.col("with")) & (F.col("cell") == F.col("near_cell"))
    return asking.alias("asking").join(near, keys & in_scope, "left_semi").select("__id", "__digest", "kind", "s", "e").distinct()


ORDER = {k: n for n, k in enumerate([*KINDS, *(w[0] for w in WEAK)])}


def written(spans: Column) -> Column:
    """kind:start:end by start, then by the kinds' order, comma-joined. spans: array<struct<s, e, kind>>."""
    rank = F.create_map(*(F.lit(x) for k, n in ORDER.items() for x in (k, n)))
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.element_at(rank, x["kind"]).alias("r"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, assign, access, hex: places, weak: array of reported weak spans) of each row of docs."""
    rows = keyed(docs, id_col, text_col)
    parts = saved(placed(rows))
    all_spans = parts.where(F.col("kind").isin(KINDS)).union(linked(parts, scope=scope).select(parts.columns))
    kept = [F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.struct("s", "e")))).alias(k) for k in KINDS]
    weak = F.sort_array(F.collect_list(F.when(~F.col("kind").isin(KINDS), F.struct("s", "e", "kind")))).alias("weak")
    found = all_spans.groupBy(F.col("__id").alias("id"), F.col("__digest").alias("digest")).agg(*kept, weak)
    joined = rows.select("__id", "__digest").join(found, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__digest") == F.col("digest")), "left")
    none = {k: F.array().cast("array<struct<s:int,e:int>>") for k in KINDS} | {"weak": F.array().cast("array<struct<s:int,e:int,kind:string>>")}
    return joined.select(F.col("__id").alias(id_col), *(F.coalesce(F.col(k), n).alias(k) for k, n in none.items()))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.concat(*(tagged(k, F.col(k)) for k in KINDS))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.concat(base, "weak")).alias("spans"))


def oracle(scope: int = SCOPE) -> str:
    def matches(kind: str, pattern: str, group: int = 0, least: int = 0) -> str:
        p = "'" + pattern.replace("'", "''") + "'"
        found = f"select id, string_split_regex(t, {p}) pieces, regexp_extract_all(t, {p}) ms, regexp_extract_all(t, {p}, {group}) gs from d where regexp_matches(t, {p})"
        each = f"select *, unnest(range(1, len(ms) + 1)) i from ({found})"
        start = "list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)"
        return f"select id, '{kind}' kind, ({start})::bigint s, ({start})::bigint + length(ms[i]) e from ({each}) where length(gs[i]) >= {least}"

    rank = "case kind " + " ".join(f"when '{k}' then {n}" for k, n in ORDER.items()) + " end"
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, " + rank + "), '')"
    role = "case when kind in ('access', 'weak_id') then 'identifier' when kind in ('assign', 'hex', 'weak_secret') then 'secret' else 'endpoint' end"
    return f"""
with d as (select row_number() over () id, doc_id, coalesce(text, '') t from documents),
base as ({" union all ".join(matches(k, FASTER.get(k, p), 0 if k in FASTER else g, 0 if k in FASTER else n) for k, p, g, n in BASE)}),
weak as (select * from ({" union all ".join(matches(k, p) for k, p in WEAK)}) w where not exists (select 1 from base b where b.id = w.id and b.s < w.e and w.s < b.e)),
part as (select distinct *, {role} as role from (select * from base union all select * from weak)),
linked as (select id, kind, s, e from part a where kind in ('weak_id', 'weak_secret') and exists (select 1 from part p where p.id = a.id and abs(p.s - a.s) <= {scope} and (p.role = 'secret') = (a.kind = 'weak_id'))),
counts as (select id, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access, count(*) filter (kind = 'hex') n_hex, {joined} written from base group by 1),
spans as (select id, {joined} spans from (select * from base union all select * from linked) group by 1)
select doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex, sha256(coalesce(written, '')) base_sha256, coalesce(spans, '') spans
from d left join counts using (id) left join spans using (id)
"""
