"""Secrets in texts, and weak parts of credentials that only count where complementary parts stand near them.

Everything is a DataFrame expression: patterns, positions, the interval join and the report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.bitmap import free_name, split_by
from daygrain.session import written


@dataclass(frozen=True)
class Kind:
    """One kind of match; ``keep`` is a SQL condition over the matched string ``m`` and ``pattern``."""

    name: str
    pattern: str
    hint: str  # a cheap condition on the text without which there is no match
    keep: str = "true"
    role: str = ""  # identifier, secret or endpoint
    weak: bool = False


# fixed values: the base patterns
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # runs are maximal, so shorter ones can be left out at once

IDENT = r"""(?i:(client_?id|access_?key_?id|account(?:_?id)?|user(?:_?name)?|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)"""
RUN = r"[A-Za-z0-9+/_.=-]{40,}"
ENDPOINT = r"""(?i:(https?|postgres|postgresql|mysql|mongodb|redis|amqp|s3|ftp|sftp|ssh))://[^\x00-\x20"'<>]+"""

KINDS = (
    Kind("assign", ASSIGN, "instr(text, '=') > 0 OR instr(text, ':') > 0", "char_length(regexp_extract(m, pattern, 2)) >= 8", "secret"),
    Kind("access", ACCESS, "instr(text, 'AKIA') > 0", "char_length(m) >= 16", "identifier"),
    Kind("hex", HEX, "true", "true", "secret"),
    Kind("ident", IDENT, "instr(text, '=') > 0 OR instr(text, ':') > 0", "char_length(regexp_extract(m, pattern, 2)) >= 3", "identifier", True),
    Kind("key", RUN, "true", "m RLIKE '^[A-Za-z0-9+/]{40}$' AND m RLIKE '[a-z]' AND m RLIKE '[A-Z]' AND m RLIKE '[0-9]'", "secret", True),
    Kind("endpoint", ENDPOINT, "instr(text, '://') > 0", "true", "endpoint", True),
)
BASE = ("assign", "access", "hex")
SCOPE = 200  # code points between the parts of one credential


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a document by its id and text, so null and repeated ids do no harm; the id's length tells where the text begins."""
    name = F.col(doc_id).cast("string")
    sized = F.coalesce(F.concat(F.char_length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    return F.md5(F.concat(sized, F.lit(":"), F.coalesce(F.col(text), F.lit(""))))


def matches(docs: DataFrame) -> DataFrame:
    """(row, kind, start, end) of every kept match: leftmost, not overlapping within a kind; in code points."""
    quoted = lambda p: p.replace("\\", "\\\\").replace("'", "\\'")
    tried = ", ".join(
        f"struct({i} AS no, '{quoted(k.pattern)}' AS pattern, "
        f"CASE WHEN {k.hint} THEN regexp_extract_all(text, '{quoted(k.pattern)}', 0) END AS found)"
        for i, k in enumerate(KINDS)
    )
    texts = docs.select(row_key().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.select("row", "text", F.explode(F.expr(f"array({tried})")).alias("k")).where("size(k.found) > 0")
    # the text between matches places them
    placed = found.select(
        "row", F.col("k.no").alias("no"), F.col("k.pattern").alias("pattern"), F.col("k.found").alias("found"),
        F.expr("transform(split(text, k.pattern, -1), g -> char_length(g))").alias("gaps"),
    ).dropDuplicates(["row", "no"])
    each = placed.select(
        "row", "no", "pattern", F.posexplode(F.arrays_zip("found", F.slice("gaps", 1, F.size("found")).alias("gaps"))).alias("at", "x")
    ).select("row", "no", "pattern", "at", F.col("x.found").alias("m"), F.col("x.gaps").alias("gap"))
    before = Window.partitionBy("row", "no").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = each.withColumn("end", F.sum(F.col("gap") + F.char_length("m")).over(before))
    keep = " ".join(f"WHEN {i} THEN {k.keep}" for i, k in enumerate(KINDS))
    return ends.where(F.expr(f"CASE no {keep} END")).select(
        "row", "no", (F.col("end") - F.char_length("m")).alias("start"), "end"
    )


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The matches to report: base ones, and weak ones with their complementary parts within ``scope``.

    An identifier needs a secret near it, a secret an identifier, an endpoint both.  A weak match inside a base one
    adds nothing.  The interval join is an equality of (row, cell of the text) and a condition on the distance.
    """
    number = F.col("no")
    named = lambda condition: [i for i, k in enumerate(KINDS) if condition(k)]
    weak = found.where(number.isin(named(lambda k: k.weak)))
    base = found.where(number.isin(named(lambda k: not k.weak)))

    def cells(rows: DataFrame, reach: int) -> DataFrame:
        first = F.floor(F.greatest(F.col("start") - reach, F.lit(0)) / scope)
        return rows.withColumn("cell", F.explode(F.sequence(first, F.floor((F.col("end") + reach) / scope))))

    def near(rows: DataFrame, others: DataFrame, how: str, distance: int) -> DataFrame:
        """Rows that have (or, anti, lack) one of the others at most ``distance`` away; each is asked in its cells."""
        left = cells(rows, 0).alias("l")
        right = cells(others, distance).select("row", "cell", "start", "end").distinct().alias("r")
        touch = F.expr(f"l.row = r.row AND l.cell = r.cell AND r.start <= l.end + {distance} AND l.start <= r.end + {distance}")
        with_one = left.join(right, touch, "left_semi").select("row", "no", "start", "end").distinct()
        return with_one if how == "semi" else rows.join(with_one, ["row", "no", "start", "end"], "left_anti")

    part = lambda role: found.where(number.isin(named(lambda k: k.role == role)))
    own = near(weak, base, "anti", 0)
    role = lambda name: own.where(number.isin(named(lambda k: k.role == name)))
    identifiers = near(role("identifier"), part("secret"), "semi", scope)
    secrets = near(role("secret"), part("identifier"), "semi", scope)
    endpoints = near(near(role("endpoint"), part("secret"), "semi", scope), part("identifier"), "semi", scope)
    return base.unionByName(identifiers).unionByName(secrets).unionByName(endpoints)


def report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Secrets of each document (doc_id, text): doc_id, row, n_assign, n_access, n_hex and spans (kind, start, end).

    Defined results: a null or empty text has none; repeated rows are reported one by one, alike; a null doc_id is a
    row like others; a match may be as long as its text; an empty table gives no rows; other columns are not read.
    """
    spans = linked(written(matches(docs), "matches"), scope).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "no", "end"))).alias("spans")
    )
    names = F.array(*[F.lit(k.name) for k in KINDS])
    rows = docs.select("doc_id", row_key().alias("row")).join(spans, "row", "left")
    empty = F.expr("cast(array() as array<struct<start: bigint, no: int, end: bigint>>)")
    rows = rows.withColumn("spans", F.coalesce("spans", empty))
    counted = [
        F.expr(f"cast(size(filter(spans, s -> s.no = {i})) as bigint)").alias(f"n_{k.name}") for i, k in enumerate(KINDS) if not k.weak
    ]
    kinds = F.transform("spans", lambda s: F.struct(names[s["no"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("doc_id", "row", *counted, kinds.alias("spans"))


def digest(rows: DataFrame) -> DataFrame:
    """The report with spans as ``kind:start:end``, comma-joined, and the hash of the base ones."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return rows.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans")
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs``, all rows and columns, with reported spans of ``text`` replaced by ``mark``, overlapping ones by one.

    ``n_chars``, where there is such a column, counts the new text.
    """
    spans = linked(written(matches(docs), "matches"), scope)
    ahead = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    begun = spans.withColumn("new", F.coalesce(F.col("start") >= F.max("end").over(ahead), F.lit(True)).cast("int"))
    runs = begun.withColumn("run", F.sum("new").over(Window.partitionBy("row").orderBy("start", "end")))
    runs = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    key, cuts = free_name(docs, "row"), free_name(docs, "cuts")
    named = written(runs.select(F.col("row").alias(key), F.col("cuts").alias(cuts)), "cuts")
    doubtful, clear = split_by(docs.withColumn(key, row_key()), named, key)
    joined = doubtful.join(named, key, "left")
    between = F.expr(
        f"transform({cuts}, (c, i) -> substring(text, int(if(i = 0, 0, element_at({cuts}, i).end)) + 1, "
        f"int(c.start - if(i = 0, 0, element_at({cuts}, i).end))))"
    )
    tail = F.expr(f"substring(text, int(element_at({cuts}, -1).end) + 1)")
    text = F.when(F.col(cuts).isNull(), F.col("text")).otherwise(F.concat(F.array_join(between, mark), F.lit(mark), tail))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(cuts).isNull(), F.col("n_chars")).otherwise(F.char_length(text).cast(docs.schema["n_chars"].dataType))
    cut = joined.select(*[(new[c] if c in new else F.col(f"`{c}`")).alias(c) for c in docs.columns])
    return clear.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(cut)
