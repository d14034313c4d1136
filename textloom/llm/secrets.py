"""Secret scan with an incremental ledger of blobs; DataFrame functions only.

Every version of every path is addressed by the hash of its content. The ledger holds
one row for each blob and rule version that has been scanned, with the spans found, so
a new batch of history reads only blobs or rule versions that it has not seen, and
findings are joined back to all paths that hold the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textloom.operators.skew import attach_group_values

# The three base patterns. The two without a group ask for the least length in
# the pattern itself; a run that is too short holds no longer one, so nothing else changes.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"


@dataclass(frozen=True)
class Rule:
    """Leftmost matches that do not overlap; with ``group``, those whose group is long enough."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0


BASE_RULES = (Rule("assign", ASSIGN, group=2, least=12), Rule("access", ACCESS), Rule("hex", HEX))
RULES = (
    *BASE_RULES,
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("login", r"://[^\s/:@]+:[^\s/:@]+@"),
    Rule("vendor", r"(?:gh[pousr]_|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16,}"),
)

LEDGER = T.StructType(
    [
        T.StructField("blob", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
    ]
)


def blob_of(text: str | Column) -> Column:
    """Content address; a null text is the empty blob."""
    c = F.col(text) if isinstance(text, str) else text
    return F.sha2(F.coalesce(c, F.lit("")).cast("binary"), 256)


def _raw_matches(text: Column, rule: Rule, wanted: Column) -> Column:
    """Length of the text before each match, of the match, and whether it counts.

    Splitting at the matches and extracting them agree on where they are, and lengths
    are in code points.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), 0)
    gaps = F.split(text, rule.pattern, -1)
    good = (
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), rule.group), lambda g: F.length(g) >= rule.least)
        if rule.group
        else F.transform(found, lambda g: F.lit(True))
    )
    rows = F.arrays_zip(
        F.slice(F.transform(gaps, lambda g: F.length(g).cast("bigint")), 1, F.size(found)).alias("gap"),
        F.transform(found, lambda g: F.length(g).cast("bigint")).alias("len"),
        good.alias("good"),
    )
    hit = F.when(text.rlike(rule.pattern), rows)
    return F.when(
        wanted,
        F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), hit.alias("hits")),
    )


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    if path is None:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def unseen(history: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...], key: str, text: str) -> DataFrame:
    """One row for each blob with rules it was not scanned by: ``blob``, ``todo`` and the text of one path."""
    names = [f"{r.kind}@{r.version}" for r in rules]
    seen = (
        ledger.select("blob", F.concat_ws("@", "kind", F.col("version").cast("string")).alias("rule"))
        .filter(F.col("rule").isin(*names))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("seen"))  # at most one for each rule
    )
    rows = history.select(F.col(key).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", blob_of("text"))
    first = rows.groupBy("blob").agg(F.min("path").alias("path"))
    todo = F.array_except(F.array(*map(F.lit, names)), F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    work = first.join(seen, "blob", "left").withColumn("todo", todo).filter(F.size("todo") > 0)
    work = work.select(F.col("blob").alias("_blob"), F.col("path").alias("_path"), "todo")
    # Path and blob together: a blob with very many paths does not meet in one task.
    same = (F.col("blob") == F.col("_blob")) & F.col("path").eqNullSafe(F.col("_path"))
    return rows.join(work, same).select("blob", "todo", "text")


def scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of ``unseen`` blobs; clean pairs have an empty list. Repeated blobs give one row."""
    each = F.array(*[_raw_matches(F.col("text"), r, F.array_contains("todo", f"{r.kind}@{r.version}")) for r in rules])
    pairs = blobs.select("blob", F.explode(each).alias("r")).filter(F.col("r").isNotNull())
    # Repeated rows of one path hold the same blob twice.
    pairs = pairs.select("blob", "r.kind", "r.version", F.posexplode_outer("r.hits").alias("pos", "hit"))
    pairs = pairs.dropDuplicates(["blob", "kind", "version", "pos"])
    so_far = Window.partitionBy("blob", "kind", "version").orderBy("pos")
    ends = pairs.withColumn("end", F.sum(F.col("hit.gap") + F.col("hit.len")).over(so_far))
    span = F.struct((F.col("end") - F.col("hit.len")).alias("start"), F.col("end"))
    return ends.groupBy("blob", "kind", "version").agg(
        F.array_sort(F.collect_list(F.when(F.col("hit.good"), span))).alias("spans")
    )


def scan_batch(
    history: DataFrame, ledger_path: str, known: str | None, rules: tuple[Rule, ...] = RULES,
    key: str = "path", text: str = "text",
) -> DataFrame:
    """Scan what is new in ``history``, write it as a ledger part at ``ledger_path``, return that part.

    ``known`` is the folder (or glob) of the parts written before, None for the first.
    Written by Spark's committer: a run that is lost leaves no part, and running a
    batch again over its own part finds nothing unseen.
    """
    spark = history.sparkSession
    fresh = scan(unseen(history, read_ledger(spark, known), rules, key, text), rules)
    fresh.select("blob", "kind", F.col("version").cast("int"), "spans").write.mode("overwrite").parquet(ledger_path)
    return read_ledger(spark, ledger_path)


def _joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.concat_ws(
        ",",
        F.transform(
            F.filter(spans, lambda s: s["kind"].isin(*kinds)),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def by_blob(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``found``: all spans of the current rule versions by start, then rule order."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.concat_ws("@", "kind", F.col("version").cast("string")).isin(*[f"{r.kind}@{r.version}" for r in rules])
    return (
        ledger.filter(current & (F.size("spans") > 0))
        .dropDuplicates(["blob", "kind"])
        .select(F.col("blob"), F.element_at(order, F.col("kind")).alias("order"), "kind", "spans")
        .select(
            "blob",
            F.transform(
                "spans",
                lambda s: F.struct(s["start"].alias("start"), F.col("order"), F.col("kind"), s["end"].alias("end")),
            ).alias("spans"),
        )
        .groupBy("blob")
        .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("found"))
    )


def findings(
    history: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "path", text: str = "text"
) -> DataFrame:
    """Each row of ``history`` (without its text) with its blob and all spans of the current rule versions.

    Adds ``blob``, ``found`` (array of start, order, kind, end: by start, then rule order).
    Null texts are empty and have no spans; repeated rows stay; a path may have any number
    of versions. Columns of ``history`` called ``blob`` or ``found`` are replaced.
    """
    of_blob = by_blob(ledger, rules)
    rows = history.drop("found").withColumn("_blob", blob_of(text)).drop("blob", text)
    rows = rows.withColumnRenamed("_blob", "blob")
    # A blob may be on very many paths: the most frequent ones do not go through the shuffle.
    sizes = rows.groupBy("blob").agg(F.count(F.lit(1)).alias("_paths"))
    joined = attach_group_values(rows, of_blob.join(sizes, "blob"), "blob", "_paths", key)
    return joined.drop("_paths").withColumn(
        "found", F.coalesce("found", F.array().cast(of_blob.schema["found"].dataType))
    )


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base kinds, hash of the base spans and all spans as text."""
    base = tuple(r.kind for r in BASE_RULES)
    counts = {f"n_{k}": F.size(F.filter("found", lambda s: s["kind"] == k)).cast("bigint") for k in base}  # noqa: B023
    return found.withColumns(
        {
            **counts,
            "base_sha256": F.sha2(_joined(F.col("found"), base).cast("binary"), 256),
            "spans": _joined(F.col("found"), tuple(r.kind for r in rules)),
        }
    ).drop("found")


def redact(
    df: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", mask: str = "[SECRET]"
) -> DataFrame:
    """``df`` with every span of the ledger replaced by ``mask``; spans that meet become one.

    Texts without a finding, null ones too, stay as they are; columns and rows stay.
    """
    found = by_blob(ledger, rules).select(F.col("blob").alias("_blob"), F.col("found").alias("_found"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(F.col(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = F.concat(acc["out"], F.array(before, F.lit(mask)))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out")
        )

    def finish(acc: Column) -> Column:
        rest = F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.length(F.col(text)))
        return F.concat(F.array_join(acc["out"], ""), rest)

    joined = df.withColumn("_key", blob_of(text)).join(found, F.col("_key") == F.col("_blob"), "left")
    masked = F.when(F.col("_found").isNotNull(), F.aggregate("_found", start, step, finish)).otherwise(F.col(text))
    return joined.withColumn(text, masked).select(*[F.col(f"`{c}`") for c in df.columns])
