"""Secrets in texts: patterns that stand for themselves, and weak parts that count only beside their complements.

DataFrame functions only. Three patterns are reported wherever they match (``BASE``). Three others are weak: a short
assigned value or a mixed token may be a secret, a name may identify an account, an address may be an endpoint; prose
holds plenty of each. A weak secret is reported only if an identifier lies within ``reach`` code points of it, or an
endpoint does that has an identifier in reach itself; an identifier only with a secret in reach, an endpoint only with
both. Strong matches count as parts.

A document's matches become numbers once (no text is kept); code point positions are running sums of the lengths
between and of the matches. The interval join of parts is a pass over a document's parts in order of place: the nearest
end before and the nearest start behind decide whether any part of a kind is in reach, so no pairs are formed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinculo.session import staged

# What is a secret by itself (kind, pattern). Matches are judged afterwards, see _long_enough.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN), ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]{16,}"))
LEAST_VALUE, LEAST_ACCESS = 12, 18  # a run of hex digits is matched whole, so its least length stands in the pattern

# Weak parts: a name of an account with its value, or the beginning of an access identifier; an assigned value too short
# for BASE, or a token of digits and both cases; an address with a scheme, or an assigned host.
WEAK = (
    (
        "identifier",
        r"""(?<![A-Za-z0-9])(?i:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}"""
        r"""|(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{8,}""",
    ),
    (
        "secret",
        r"""(?<![A-Za-z0-9])(?i:pass(?:word|wd|phrase)?|pwd|secret(?:_?key)?|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=!@#$%^&*-]{6,}"""
        r"""|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]{0,60}[0-9])(?=[A-Z0-9+/_-]{0,60}[a-z])(?=[a-z0-9+/_-]{0,60}[A-Z])[A-Za-z0-9+/_-]{24,}={0,2}""",
    ),
    (
        "endpoint",
        r"""(?<![A-Za-z0-9])[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]{3,}"""
        r"""|(?<![A-Za-z0-9])(?i:host(?:name)?|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:_-]{3,}""",
    ),
)

PATTERNS = BASE + WEAK
KINDS = [kind for kind, _ in PATTERNS]  # in the order of a document's spans at one place
STRONG = [kind for kind, _ in BASE]
PART_OF = {"assign": "secret", "hex": "secret", "access": "identifier"}  # what strong matches count as
REACH = 200

MATCHES = "array<struct<kind:string,i:int,gap:int,size:int,whole:boolean>>"


def _long_enough(kind: str, body: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(body, ASSIGN, 2)) >= LEAST_VALUE
    return F.length(body) >= (LEAST_ACCESS if kind == "access" else 0)


def _matches(kind: str, pattern: str) -> Column:
    """The matches in column ``kind`` of the text ``t``, as numbers: code points since the last match, and their own."""
    gaps = F.slice(F.split("t", pattern, -1), F.lit(1), F.size(kind))
    both = F.zip_with(gaps, kind, lambda gap, body: F.struct(F.length(gap).alias("gap"), F.length(body).alias("size"), _long_enough(kind, body).alias("whole")))
    rows = F.transform(
        both, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["size"].alias("size"), x["whole"].alias("whole"))
    )
    return F.when(F.size(kind) > 0, rows.cast(MATCHES)).otherwise(F.array().cast(MATCHES))


def located(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(``row``, ``id``, ``found``) for every row, written to the shared folder: all matches as numbers, without texts.

    Matches of a kind are leftmost and do not overlap. ``row`` tells rows apart that share an id.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("t"))
    rows = rows.select("id", "t", *[F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias(k) for k, p in PATTERNS])
    found = F.concat(*[_matches(k, p) for k, p in PATTERNS])
    return staged(rows.select(F.monotonically_increasing_id().alias("row"), "id", found.alias("found")), "matches")


def spans_of(rows: DataFrame) -> DataFrame:
    """(``row``, ``kind``, ``start``, ``stop``) of every match of :func:`located` that is long enough, ends exclusive."""
    each = rows.select("row", F.inline("found"))
    stop = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row", "kind").orderBy("i"))
    return each.withColumn("stop", stop).where("whole").select("row", "kind", (F.col("stop") - F.col("size")).alias("start"), "stop")


def _in_reach(which: Column, reach: int) -> Column:
    """Whether another part for which ``which`` holds lies within ``reach`` code points: the nearest before or behind does."""
    placed = Window.partitionBy("row").orderBy("start", "stop", "kind")
    before = F.max(F.when(which, F.col("stop"))).over(placed.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.min(F.when(which, F.col("start"))).over(placed.rowsBetween(1, Window.unboundedFollowing))
    return F.coalesce(F.col("start") - before <= reach, F.lit(False)) | F.coalesce(behind - F.col("stop") <= reach, F.lit(False))


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """The spans that are reported: all strong ones, and weak ones whose complements are in reach.

    A weak span that overlaps a strong one is the same thing seen twice: it is left out and is no part.
    """
    strong = F.col("kind").isin(STRONG)
    by_start = Window.partitionBy("row").orderBy("start")
    reaching = F.max(F.when(strong, F.col("stop"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    following = F.min(F.when(strong, F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    twice = F.coalesce(reaching > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("stop"), F.lit(False))
    part = reduce(lambda c, kind: c.when(F.col("kind") == kind, PART_OF[kind]), PART_OF, F.when(F.lit(False), ""))
    parts = spans.withColumn("twice", twice).where(strong | ~F.col("twice"))
    parts = parts.withColumn("part", part.otherwise(F.col("kind")))
    parts = parts.withColumns({f"near_{x}": _in_reach(F.col("part") == x, reach) for x in ("identifier", "secret")})
    # An endpoint with an identifier in reach stands for it.
    parts = parts.withColumn("known", (F.col("part") == "endpoint") & F.col("near_identifier"))
    parts = parts.withColumn("near_known", _in_reach(F.col("known"), reach))
    complete = (
        F.when(F.col("kind") == "secret", F.col("near_identifier") | F.col("near_known"))
        .when(F.col("kind") == "identifier", F.col("near_secret"))
        .when(F.col("kind") == "endpoint", F.col("near_identifier") & F.col("near_secret"))
        .otherwise(F.lit(True))
    )
    return parts.where(complete).select("row", "kind", "start", "stop")


def find_secrets(docs: DataFrame, reach: int = REACH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``spans`` array of (``start``, ``kind``, ``stop``)) for every row of ``docs``, in order of place and of kind.

    Whole texts; null and empty texts have no spans. Positions count code points, ends exclusive. ``kind`` is one of
    ``KINDS``; the first three are reported wherever they match, the others as :func:`linked` says. Null and repeated ids and
    repeated rows stay, other columns are ignored, an empty table gives an empty result. A row's matches meet in one task,
    its text does not.
    """
    rows = located(docs, id_column, text_column)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(F.col("start"), rank.alias("rank"), F.col("stop"), F.col("kind"))
    spans = linked(spans_of(rows), reach).groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    plain = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop")))
    none = F.array().cast("array<struct<start:bigint,kind:string,stop:bigint>>")
    result = rows.select("row", "id").join(spans, "row", "left").select("id", F.coalesce(plain, none).alias("spans"))
    return result.withColumnRenamed("id", id_column)
