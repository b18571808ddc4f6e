"""Secret scans over all versions of all files, by an incremental ledger of blobs.

Every version is addressed by the SHA-256 of its content. The ledger, a Parquet table in a folder, holds one row per blob
and rule version that was scanned, with the spans found. A scan reduces the versions to distinct blobs, takes away the pairs
of blob and rule version that the ledger knows, scans what remains, appends it, and joins the findings back to every
path whose content is the blob. A rule that is changed gets a new version and is the only one that runs again.

Spans are code points, end exclusive. Every match of a rule is found leftmost and without overlap; matches
that are too short are dropped afterwards, so they still consume their text.

Defined cases: a null text is empty; an empty text has no finding; repeated rows are scanned once and reported each; null
identifiers are reported as they are; other columns are ignored; an empty table gives an empty result. If a scan is
broken off, its part of the ledger is not visible and the pairs are scanned again; a pair that two scans wrote counts once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import table

LEDGER = "blob binary, kind string, version int, spans array<struct<start:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` has no groups but those that ``measured`` counts; ``least`` is the fewest characters."""

    kind: str
    version: int
    pattern: str
    least: int
    #: The group whose length counts; 0 is the whole match.
    measured: int = 0
    #: A cheaper pattern without which there is no finding.
    gate: str = ""
    base: bool = True


# The base patterns and lengths of the contract, in its order; then what this package adds. A match of the
# access and hex patterns runs to the end of its characters, so the fewest characters can stand in the pattern: what is
# left out has no shorter or later match that would pass. A match of assign that is too short still hides what it covers.
_KEYWORDS = "(?i:password|passwd|secret|token|api_?key)"
# A private key runs to its END line; without one, over its header lines and base64 lines and a last, shorter line. The
# pattern has no look-around, which SQL lacks, and the repetitions are bounded for the depth of Java's matcher: 300
# lines are more than those of an RSA key of 16,384 bits.
_BASE64, _GAP = "[A-Za-z0-9+/=]", r"[\x20\t\r\n\\]"
_LINES = ("(?:" + _GAP + "+" + _BASE64 + "{16}" + _BASE64 + "*){0,60}") * 5
_PEM = (
    "-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:--?-?-?[^-]+){0,300}-*-----END [A-Z ]*PRIVATE KEY-----|"
    + "(?:" + _GAP + r"+[A-Z][A-Za-z-]*:\x20[^\r\n]*){0,20}" + _GAP + "+" + _BASE64 + "{16}" + _BASE64 + "*" + _LINES
    + "(?:" + _GAP + r"*\n" + _BASE64 + r"+[\x20\t\r]*(?:\n|\z))?)?"
)
RULES = (
    Rule("assign", 1, "(" + _KEYWORDS + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, _KEYWORDS),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}", 20, gate="AKIA"),
    Rule("hex", 1, "[0-9a-f]{24,}", 24, gate="[0-9a-f]{24}"),
    Rule("pem", 3, _PEM, 1, gate="PRIVATE KEY-----", base=False),
)


def spans_of(text: Column, rule: Rule) -> Column:
    r"""array<struct<start, end>> of a rule's findings in order; empty where there is none.

    One pass takes every match together with what stands before it since the last one, a second pass that part alone;
    their lengths give the places. \G lets a search start at the end of the last match only, so the rest of a text
    behind its last match is gone through once.
    """
    led = F.lit(f"\\G([\\s\\S]*?)({rule.pattern})")
    before = F.transform(F.regexp_extract_all(text, led, F.lit(1)), F.length)
    whole = F.transform(F.regexp_extract_all(text, led, F.lit(2)), F.length)
    measured = whole
    if rule.measured:
        measured = F.transform(F.regexp_extract_all(text, led, F.lit(2 + rule.measured)), F.length)
    found = F.arrays_zip(before.alias("before"), whole.alias("whole"), measured.alias("measured"))
    nothing = F.array().cast("array<struct<start:long,end:long,measured:long>>")

    def placed(done: Column, match: Column) -> Column:
        start = F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0).cast("long")) + match["before"]
        span = F.struct(start.alias("start"), (start + match["whole"]).alias("end"), match["measured"].cast("long").alias("measured"))
        return F.concat(done, F.array(span))

    kept = F.filter(F.aggregate(found, nothing, placed), lambda s: s["measured"] >= rule.least)
    spans = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    empty = F.array().cast("array<struct<start:long,end:long>>")
    return F.when(F.rlike(text, F.lit(rule.gate or rule.pattern)), spans).otherwise(empty)


def versions(docs: DataFrame) -> DataFrame:
    """(doc_id, blob, text): every row as a version of the file that its identifier names."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text"))


def read_ledger(spark: SparkSession, ledger: str, rules=RULES) -> DataFrame:
    """The ledger's rows of the given rule versions; none if it does not exist yet."""
    try:
        rows = spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    current = F.lit(False)
    for rule in rules:
        current = current | ((F.col("kind") == rule.kind) & (F.col("version") == rule.version))
    return rows.filter(current)


def scan_new(spark: SparkSession, history: DataFrame, ledger: str, rules=RULES) -> None:
    """Scan the blobs of ``history`` for the rule versions that the ledger has not seen of them, and append the outcome."""
    seen = read_ledger(spark, ledger, rules).groupBy("blob").agg(F.collect_set("kind").alias("seen"))
    blobs = history.select("blob", "text").dropDuplicates(["blob"])
    due = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    outcome = F.array(*(
        F.when(~F.array_contains("seen", rule.kind), F.struct(
            F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), spans_of(F.col("text"), rule).alias("spans")
        ))
        for rule in rules
    ))
    fresh = due.select("blob", F.explode(F.filter(outcome, lambda o: o.isNotNull())).alias("o")).select("blob", "o.*")
    fresh.write.mode("append").parquet(ledger)


def findings(spark: SparkSession, ledger: str, rules=RULES) -> DataFrame:
    """(blob, found): per blob with a finding, array<struct<start, rank, end, kind>> in order; rank is the rule's place."""
    rank = F.lit(len(rules))
    for place, rule in enumerate(rules):
        rank = F.when(F.col("kind") == rule.kind, F.lit(place)).otherwise(rank)
    each = read_ledger(spark, ledger, rules).filter("size(spans) > 0").select("blob", "kind", rank.alias("rank"), "spans")
    flat = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank"), s["end"].alias("end"), F.col("kind")))
    return (
        each.groupBy("blob").agg(F.collect_set(flat).alias("lists"))
        .select("blob", F.array_sort(F.array_distinct(F.flatten("lists"))).alias("found"))
    )


def scan(spark: SparkSession, docs: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """(doc_id, found) of every row, after scanning what the ledger has not seen."""
    history = versions(docs)
    scan_new(spark, history, ledger, rules)
    nothing = F.array().cast("array<struct<start:long,rank:int,end:long,kind:string>>")
    joined = history.select("doc_id", "blob").join(findings(spark, ledger, rules), "blob", "left")
    return joined.select("doc_id", F.coalesce("found", nothing).alias("found"))


def digests(scanned: DataFrame, rules=RULES) -> DataFrame:
    """Counts and span lists of each row."""
    base = [r.kind for r in rules if r.base]

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("found", lambda s: s["kind"].isin(base))
    return scanned.select(
        "doc_id", *(count(kind) for kind in base), F.sha2(listed(of_base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def redacted(spark: SparkSession, docs: DataFrame, ledger: str, mask: str = "[SECRET]", rules=RULES) -> DataFrame:
    """The rows with every secret replaced by ``mask`` and the character count adjusted; rows without a finding as they are."""
    scan_new(spark, versions(docs), ledger, rules)
    content = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.unhex(F.sha2(content, 256)).alias("blob"))
    text = F.col("row.text")

    def cut(done: Column, span: Column) -> Column:
        apart = span["start"] >= done["at"]  # else it overlaps the span before, whose mask stands for both
        between = F.substr(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        added = F.when(apart, F.concat(between, F.lit(mask))).otherwise(F.lit(""))
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), F.concat(done["text"], added).alias("text"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"))
    masked = F.aggregate(
        "found", start, cut, lambda done: F.concat(done["text"], F.substr(text, (done["at"] + 1).cast("int")))
    )
    new = {"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}
    columns = [
        F.when(F.col("masked").isNotNull(), new[c]).otherwise(F.col(f"row.{c}")).alias(c) if c in new else F.col(f"row.{c}")
        for c in docs.columns
    ]
    return rows.join(findings(spark, ledger, rules), "blob", "left").withColumn("masked", masked).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, with a ledger of its own."""
    return digests(scan(spark, table(spark, sf_dir, "documents"), scratch_path(spark, "ledger")))


def _sql_spans(rule: Rule, rank: int) -> str:
    pattern = "(?s)(.*?)(" + rule.pattern.replace("'", "''") + ")"
    part = lambda group: f"unnest(regexp_extract_all(text, '{pattern}', {group}))"
    return f"""
  select doc_id, '{rule.kind}' as kind, {rank} as rank, ends - whole as start, ends as stop from (
    select *, sum(before + whole) over (partition by doc_id order by i) as ends from (
      select doc_id, unnest(range(len(regexp_extract_all(text, '{pattern}')))) as i, length({part(1)}) as before,
        length({part(2)}) as whole, length({part(2 + rule.measured)}) as measured
      from documents)) where measured >= {rule.least}"""


_EACH = " union all ".join(_sql_spans(rule, rank) for rank, rule in enumerate(RULES))
ORACLE = f"""
with spans as ({_EACH}),
listed as (
  select doc_id, {", ".join(f"count(*) filter (where kind = '{r.kind}') as n_{r.kind}" for r in RULES if r.base)},
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (where rank < 3) as base
  from spans group by doc_id)
select documents.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}" for r in RULES if r.base)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join listed using (doc_id)
"""
