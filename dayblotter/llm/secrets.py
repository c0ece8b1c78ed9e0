"""Secret scans with an incremental ledger of blobs.

Every version of a document is a blob, named by the hash of its text. The ledger, a folder, records
which (blob, rule, rule version) were scanned and what was found. A run scans only what the ledger
does not have, and joins findings back to every path that holds the blob.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayblotter.llm.common import stored, table, without
from dayblotter.session import new_folder, path_exists


@dataclass(frozen=True)
class Rule:
    """A pattern for secrets. Matches are leftmost and do not overlap; too short ones are dropped.

    `measured` is the group whose length in characters must reach `shortest`. A change of any other
    field needs a new `version`, which has every blob scanned anew by this rule.
    """

    kind: str
    pattern: str
    measured: int = 0
    shortest: int = 1
    version: int = 1


_BASE64 = "[A-Za-z0-9+/=]"
_LABEL = r"(?:[A-Z]+ )*PRIVATE KEY-----"
# From the header to its END line, with no other such line between (20 stretches of up to four dashes
# are as many as the fields above a key have). Without an END line: those fields, the base64 that begins
# the lines that follow, and long runs of it where lines were joined by blanks. A line end may be written
# as an escape. Groups are repeated up to bounds, beyond any key, since each time takes stack.
_PRIVATE_KEY = (
    rf"-----BEGIN {_LABEL}(?:[^-]*(?:-{{1,4}}[^-]+){{0,20}}-----END {_LABEL}"
    rf"|(?:\s*[A-Za-z]+-[A-Za-z]+:[^\r\n]*){{0,4}}(?:\x20*{_BASE64}{{16}}{_BASE64}*)?"
    rf"(?:[\x20\t]*[\r\n\\][\s\\]*{_BASE64}+){{0,500}}(?:\x20{_BASE64}{{16}}{_BASE64}*){{0,60}}"
    rf"(?:\x20[A-Za-z0-9+/]+=+)?)"
)

# The first three kinds and their order.
RULES = [
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
        measured=2,
        shortest=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", shortest=20),
    Rule("hex", r"[0-9a-f]+", shortest=24),
    Rule("private_key", _PRIVATE_KEY, version=2),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]

_PAIRS = "blob string, rule string, version int"
_FOUND = "blob string, rule string, version int, start long, end long"


def _searched(rule: Rule) -> str:
    """A pattern that is found exactly where a match that is long enough is, for a first look.

    Runs of one class of characters that are too short are skipped as one; the look at matches
    themselves then need not count them.
    """
    if rule.measured == 0 and rule.shortest > 1 and rule.pattern.endswith("]+"):
        fixed = rule.pattern[: rule.pattern.index("[")]
        return f"{rule.pattern[:-1]}{{{rule.shortest - len(fixed)},}}"
    return rule.pattern


def _matches(text: Column, rule: Rule) -> Column:
    """Of each match, in order: characters since the match before, its own, and the measured ones."""
    # Each match begins where the last one ended (\G), so the text is walked once.
    walked = F.lit(rf"(?s)\G(.*?)({_searched(rule)})")
    gaps = F.transform(F.regexp_extract_all(text, walked, F.lit(1)), F.length)
    spans = F.transform(F.regexp_extract_all(text, walked, F.lit(2)), F.length)
    sized = F.transform(F.regexp_extract_all(text, walked, F.lit(2 + rule.measured)), F.length)
    return F.when(F.regexp_like(text, F.lit(_searched(rule))), F.arrays_zip(gaps, spans, sized))


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Findings in `blobs` (blob, text, due: the kinds to scan for), a row for each span.

    Offsets are in code points, the end exclusive.
    """
    found = F.array(
        *[
            F.struct(
                F.lit(rule.kind).alias("rule"),
                F.lit(rule.version).alias("version"),
                F.lit(rule.shortest).alias("shortest"),
                F.when(F.array_contains("due", rule.kind), _matches(F.col("text"), rule))
                .cast("array<struct<gap int, length int, measured int>>")
                .alias("matches"),
            )
            for rule in rules
        ]
    )
    # A sum over the matches of one rule in one blob gives offsets; only lengths are shuffled for it.
    so_far = "sum(gap + length) over (partition by blob, rule order by place)"
    return (
        blobs.select("blob", F.explode(F.filter(found, lambda f: F.size("due") > 0)).alias("_f"))
        .where("size(_f.matches) > 0")
        .select("blob", "_f.rule", "_f.version", "_f.shortest", F.posexplode("_f.matches").alias("place", "_m"))
        .select("blob", "rule", "version", "shortest", "place", "_m.*")
        .withColumn("end", F.expr(so_far))
        .where("measured >= shortest")
        .select("blob", "rule", "version", F.expr("end - length").alias("start"), "end")
    )


class Ledger:
    """What was scanned and found, as two Parquet tables that are only ever added to.

    Findings are written before the pairs that account for them. A run that dies between the two is
    repeated, and finds the same; findings are read as a set. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.path}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def findings(self, rules: Sequence[Rule]) -> DataFrame:
        now = " or ".join(f"(rule = '{rule.kind}' and version = {rule.version})" for rule in rules)
        return self._read("findings", _FOUND).where(now or "false").distinct()

    def pairs(self) -> DataFrame:
        return self._read("pairs", _PAIRS)

    def update(self, blobs: DataFrame, rules: Sequence[Rule] = RULES) -> None:
        """Scan the (blob, rule version) pairs of `blobs` (blob, text) that were not scanned before.

        Equal blobs are scanned once.
        """
        wanted = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
        kinds = F.transform(wanted, lambda pair: pair["rule"])
        distinct = blobs.dropDuplicates(["blob"])
        if path_exists(self.spark, f"{self.path}/pairs"):
            done = (
                self.pairs()
                .withColumn("_pair", F.struct("rule", "version"))
                .groupBy("blob")
                .agg(F.collect_set("_pair").alias("_done"))  # of as many as there are rule versions
            )
            left = F.array_except(wanted, F.coalesce("_done", F.array().cast("array<struct<rule string, version int>>")))
            joined = distinct.join(done, "blob", "left")
            fresh = joined.withColumn("due", F.transform(left, lambda pair: pair["rule"])).drop("_done")
            fresh = fresh.where("size(due) > 0")
        else:
            fresh = distinct.withColumn("due", kinds)
        scan(fresh, rules).write.mode("append").parquet(f"{self.path}/findings")
        versions = F.create_map(*[part for r in rules for part in (F.lit(r.kind), F.lit(r.version))])
        fresh.select("blob", F.explode("due").alias("rule")).withColumn(
            "version", versions[F.col("rule")]
        ).write.mode("append").parquet(f"{self.path}/pairs")


def with_spans(
    docs: DataFrame, text: str, ledger: Ledger, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Documents with `spans`: an array of (start, place, rule, end), by start, then kind as listed.

    `place` is the kind's place in `rules`. A null text is scanned as an empty one; a document
    without findings has an empty array. Repeated rows, and all that share a text, get the same
    spans. Input columns named like added ones give way to them.
    """
    held = without(docs, ["spans", "_blob"])
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    ledger.update(held.select(F.sha2(content, 256).alias("blob"), content.alias("text")), rules)
    places = F.create_map(*[part for i, r in enumerate(rules) for part in (F.lit(r.kind), F.lit(i))])
    found = stored(
        ledger.findings(rules)
        .withColumn("_span", F.struct("start", places[F.col("rule")].alias("place"), "rule", "end"))
        .groupBy(F.col("blob").alias("_blob"))
        .agg(F.sort_array(F.collect_list("_span")).alias("spans")),  # those of one text
        "secrets",
    )
    empty = F.array().cast("array<struct<start bigint, place int, rule string, end bigint>>")
    return (
        held.withColumn("_blob", F.sha2(content, 256))
        .join(found, "_blob", "left")
        .withColumn("spans", F.coalesce("spans", empty))
        .drop("_blob")
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch of overlapping spans replaced by `mark`.

    Spans are in order; the part kept before a span begins where the furthest span so far ended.
    """
    joined = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda done, span: F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(
                (span["start"] >= done["at"]) ,
                F.concat(
                    done["parts"],
                    F.array(
                        text.substr((done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int")),
                        F.lit(mark),
                    ),
                ),
            )
            .otherwise(done["parts"])
            .alias("parts"),
        ),
        lambda done: F.concat(
            F.concat_ws("", done["parts"]), text.substr((done["at"] + 1).cast("int"), F.length(text))
        ),
    )
    return F.when(F.size(spans) > 0, joined).otherwise(text)


def op9_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = Ledger(spark, new_folder(spark, "ledger"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == kind)).cast("long").alias(f"n_{kind}")

    def written(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])))

    base = F.filter("spans", lambda s: s["place"] < 3)
    return with_spans(docs, "text", ledger).select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    """The same walk over matches in SQL: lengths of what lies before each match, and of the match."""
    walks = []
    for place, rule in enumerate(RULES):
        walked = f"(?s)(.*?)({rule.pattern})".replace("'", "''")
        walks.append(
            f"select doc_id, {place} as place, '{rule.kind}' as rule, {rule.shortest} as shortest, "
            + ", ".join(
                f"unnest(list_transform(regexp_extract_all(text, '{walked}', {group}), lambda x: length(x))) as {name}"
                for name, group in (("gap", 1), ("size", 2), ("measured", 2 + rule.measured))
            )
            + f", generate_subscripts(regexp_extract_all(text, '{walked}', 1), 1) as nth from docs"
        )
    return f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
walked as ({" union all ".join(walks)}),
spans as (
  select *, sum(gap + size) over (partition by doc_id, rule order by nth) as stop from walked
), found as (
  select doc_id, place, rule, (stop - size)::bigint as start, stop::bigint as stop from spans where measured >= shortest
), written as (
  select doc_id,
    count(*) filter (place = 0) as n_assign, count(*) filter (place = 1) as n_access, count(*) filter (place = 2) as n_hex,
    string_agg(rule || ':' || start || ':' || stop, ',' order by start, place) filter (place < 3) as base,
    string_agg(rule || ':' || start || ':' || stop, ',' order by start, place) as spans
  from found group by doc_id
)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs d left join written w on d.doc_id = w.doc_id
"""


ORACLE = _oracle()
