"""Secret scan: strong patterns as they are, weak ones where their counterparts stand close by.

Strong spans (``assign``, ``access``, ``hex``) are reported always. A credential has
several parts: an identifier (an access key, or the weak ``identity``), a secret (an
assignment, a long hex run, or the weak ``opaque``) and perhaps an ``endpoint``. Weak parts
are too common to be reported alone. Each opens a scope, its span and ``reach`` code points
on both sides, and an interval join finds the other parts that reach into it:

* an ``identity`` is reported if a secret does,
* an ``opaque`` run if an identifier does,
* an ``endpoint`` if both do.

Weak spans that overlap a strong one are dropped first and take no part in this.

Texts are read once, by built-in functions only: the matches of a pattern and the pieces
between them give gaps and lengths, and only these numbers leave the scan. Starts are running
sums of them. Joins are on document and cell of ``CELL`` code points, so that what meets under
one key is bounded by the width of a cell, not by the length of a document.

Null texts count as empty, with no spans; null and repeated doc_ids keep a row each; other
columns are not read. An empty table gives an empty result. Texts are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apothecary.llm.shared import stored


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _words(*words: str) -> str:
    return "(" + "|".join(map(_any_case, words)) + ")"


_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
_SECRET_NAMES = _words("password", "passwd", "secret", "token", "api_?key")
_USER_NAMES = _words("user_?name", "user_?id", "user", "login", "client_?id", "access_?key_?id", "account")
#: Kinds in the order of the report. All patterns are linear in the text: no class before a
#: literal is repeated without a bound.
PATTERNS = {
    "assign": _SECRET_NAMES + _GIVEN + r"([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "identity": _USER_NAMES + _GIVEN + r"[A-Za-z0-9@+_.-]+|[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+",
    "opaque": r"[A-Za-z0-9+/_-]{32,}={0,2}",
    "endpoint": r"(https?|ftp|s3|jdbc:[a-z]+|postgres(ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+",
}
STRONG = ("assign", "access", "hex")
IDENTIFIERS, SECRETS = ("access", "identity"), ("assign", "hex", "opaque")
CELL = 512


@dataclass(frozen=True)
class SecretSettings:
    """``reach``: code points of a scope to each side of a weak part."""

    reach: int = 200


def _kept(kind: str, match: Column) -> Column:
    """Whether a match of the pattern is long or mixed enough."""
    if kind == "assign":
        return F.length(F.regexp_extract(match, PATTERNS[kind], 2)) >= 6
    if kind == "access":
        return F.length(match) >= 20
    if kind == "opaque":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.lit(True)


def _matches(text: Column, order: int, kind: str) -> Column:
    """Of each match: its kind, number, code points since the last one, own code points, whether it is kept."""
    pattern = PATTERNS[kind]
    found = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda piece, match: F.struct(F.length(piece).alias("gap"), F.length(match).alias("size"), _kept(kind, match).alias("kept")),
    )
    numbered = F.transform(found, lambda m, i: F.struct(F.lit(order).alias("kind"), i.alias("i"), m["gap"].alias("gap"), m["size"].alias("size"), m["kept"].alias("kept")))
    # The piece after the last match has none beside it.
    return F.when(text.rlike(pattern), F.filter(numbered, lambda m: m["size"].isNotNull())).otherwise(F.array())


def scanned(docs: DataFrame) -> DataFrame:
    """(row, doc_id, matches) of each document; rows are numbered and written, so that the numbers hold."""
    text = F.coalesce("text", F.lit(""))
    found = F.concat(*[_matches(text, n, kind) for n, kind in enumerate(PATTERNS)])
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", found.alias("matches")), "matches")


def parts(scan: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the kept matches; ``kind`` counts as in ``PATTERNS``."""
    each = scan.where(F.size("matches") > 0).select("row", F.explode("matches").alias("m")).select("row", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
    return each.where("kept").select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def _cells(spans: DataFrame, before: int) -> DataFrame:
    """Spans, widened by ``before`` to both sides, once for each cell they touch."""
    first = F.floor(F.greatest(F.col("start") - before, F.lit(0)) / CELL)
    return spans.withColumn("cell", F.explode(F.sequence(first, F.floor((F.col("end") + before - 1) / CELL))))


def _meeting(spans: DataFrame, others: DataFrame, reach: int) -> DataFrame:
    """Each span with each of the others less than ``reach`` away from it, once or more."""
    left = _cells(spans, reach)
    right = _cells(others, 0).select(
        F.col("row").alias("o_row"), F.col("cell").alias("o_cell"), F.col("kind").alias("o_kind"),
        F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    same = (F.col("row") == F.col("o_row")) & (F.col("cell") == F.col("o_cell"))
    near = (F.col("o_start") < F.col("end") + reach) & (F.col("o_end") > F.col("start") - reach)
    return left.join(right, same & near)


def _one_of(column: str, kinds: tuple[str, ...]) -> Column:
    return F.col(column).isin([n for n, k in enumerate(PATTERNS) if k in kinds])


def linked(found: DataFrame, settings: SecretSettings = SecretSettings()) -> DataFrame:
    """The weak parts whose counterparts are within reach, as (row, kind, start, end)."""
    strong, weak = found.where(_one_of("kind", STRONG)), found.where(~_one_of("kind", STRONG))
    # Strong parts alone give nothing to link.
    by = ["row", "kind", "start", "end"]
    covered = _meeting(weak, strong, 0).select(*by).distinct()
    free = weak.join(covered, by, "left_anti")
    met = _meeting(free, strong.unionByName(free), settings.reach).groupBy(*by).agg(
        F.bool_or(_one_of("o_kind", IDENTIFIERS)).alias("identified"), F.bool_or(_one_of("o_kind", SECRETS)).alias("secret"))
    complete = (
        F.when(_one_of("kind", ("identity",)), F.col("secret"))
        .when(_one_of("kind", ("opaque",)), F.col("identified"))
        .otherwise(F.col("identified") & F.col("secret"))
    )
    return met.where(complete).select(*by)


def _listed(spans: Column) -> Column:
    """Spans in order of start, then kind, as ``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, PATTERNS))
    line = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(line, ",")


def spans(docs: DataFrame, settings: SecretSettings = SecretSettings()) -> DataFrame:
    """(row, doc_id, found): of each document the strong spans and the linked weak ones."""
    scan = scanned(docs)
    found = stored(parts(scan), "parts")
    reported = found.where(_one_of("kind", STRONG)).unionByName(linked(found, settings))
    per_row = reported.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("found"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return scan.select("row", "doc_id").join(per_row, "row", "left").select("row", "doc_id", F.coalesce("found", none).alias("found"))


def _count(order: int) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == order)).cast("long")


def digest(docs: DataFrame, settings: SecretSettings = SecretSettings()) -> DataFrame:
    """Counts and digest of the strong spans, and all spans as text."""
    strong = F.filter("found", lambda s: s["kind"] < len(STRONG))
    count = [_count(n).alias(f"n_{kind}") for n, kind in enumerate(STRONG)]
    return spans(docs, settings).select(
        "doc_id", *count, F.sha2(_listed(strong).cast("binary"), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def _sql_hits(order: int, kind: str, kept: str) -> str:
    pattern = PATTERNS[kind].replace("'", "''")
    return f"""
    SELECT id, {order} AS kind, i, length(piece) AS gap, length(hit) AS size, {kept.replace("PATTERN", f"'{pattern}'")} AS kept FROM (
      SELECT id, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(pieces[1:len(hits)]) AS piece FROM (
        SELECT id, regexp_extract_all(text, '{pattern}', 0) AS hits, string_split_regex(text, '{pattern}') AS pieces
        FROM docs WHERE regexp_matches(text, '{pattern}')))"""


_KEPT_SQL = {"assign": "length(regexp_extract(hit, PATTERN, 2)) >= 6", "access": "length(hit) >= 20",
             "opaque": "regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')"}
_REACH = SecretSettings().reach
ORACLE = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({" UNION ALL ".join(_sql_hits(n, k, _KEPT_SQL.get(k, "true")) for n, k in enumerate(PATTERNS))}),
placed AS (SELECT *, sum(gap + size) OVER (PARTITION BY id, kind ORDER BY i)::BIGINT AS stop FROM hits),
parts AS MATERIALIZED (SELECT id, kind, stop - size AS start, stop FROM placed WHERE kept),
free AS MATERIALIZED (SELECT * FROM parts w WHERE kind >= 3 AND NOT EXISTS (
  SELECT 1 FROM parts s WHERE s.id = w.id AND s.kind < 3 AND s.start < w.stop AND s.stop > w.start)),
all_parts AS (SELECT * FROM parts WHERE kind < 3 UNION ALL SELECT * FROM free),
met AS (
  SELECT f.id, f.kind, f.start, f.stop, bool_or(o.kind IN (1, 3)) AS identified, bool_or(o.kind IN (0, 2, 4)) AS secret
  FROM free f JOIN all_parts o ON f.id = o.id AND o.start < f.stop + {_REACH} AND o.stop > f.start - {_REACH}
  GROUP BY ALL),
reported AS (
  SELECT id, kind, start, stop FROM parts WHERE kind < 3 UNION ALL
  SELECT id, kind, start, stop FROM met
  WHERE CASE kind WHEN 3 THEN secret WHEN 4 THEN identified ELSE identified AND secret END),
named AS (SELECT *, ['assign', 'access', 'hex', 'identity', 'opaque', 'endpoint'][kind + 1] || ':' || start || ':' || stop AS line FROM reported),
listed AS (
  SELECT id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
    string_agg(line, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(line, ',' ORDER BY start, kind) AS spans
  FROM named GROUP BY id)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (id)
"""
