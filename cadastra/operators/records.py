"""Application rows, plots, validation and review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.functions import cells as ce
from cadastra.functions import scalars as sc

# Texts that reviewers see.
MIXED_SURVEY = (
    "Survey numbers may be mixed with a neighbouring record's: the parser merged the "
    "Sr. No. and survey columns on this page. Check against the PDF."
)
DISPUTED_SPLIT = (
    "Unsure where this record ends: for a row without a Sr. No., the Sr. No. sequence and "
    "the row's contents disagree on whether it continues the record above. Check against the PDF."
)


def application_rows(records: DataFrame) -> DataFrame:
    """Rows of the application schema plus ``review_reason`` and ``row_seq``.

    Input: ``raw`` (struct of fields), variant, confidence, span and table keys, ``suspect_sr``,
    ``disputed``.  Pages are those of the span."""
    raw = {f: F.col(f"raw.{f}") for f in schemas.FIELDS}
    place = F.col("_place")
    suspect = F.when(F.size("suspect_sr") > 0, F.coalesce(F.array_contains("suspect_sr", ce.parse_sr(raw["sr_no"])), F.lit(False)))
    reasons = F.concat_ws(" ", F.when(suspect, MIXED_SURVEY), F.when(F.col("disputed"), DISPUTED_SPLIT))
    return records.withColumn("_place", sc.split_place(raw["village_taluka"])).select(
        "gazette_id",
        "source_filename",
        "notification_no",
        F.col("variant").alias("table_variant"),
        raw["sr_no"].alias("sr_no"),
        F.when(F.col("variant") != "ndz", raw["applicant"]).alias("applicant"),
        raw["survey"].alias("survey_raw"),
        place["village"].alias("village"),
        place["taluka"].alias("taluka"),
        raw["existing_use"].alias("existing_use"),
        sc.total_area(raw["existing_use"]).alias("total_area_sqm"),
        raw["proposed_use"].alias("proposed_use"),
        sc.indian_int(raw["area_proposed"]).alias("area_proposed_sqm"),
        raw["decision"].alias("decision"),
        F.col("page_start").alias("page_from"),
        F.col("page_end").alias("page_to"),
        "confidence",
        sc.row_hash(F.col("gazette_id"), F.col("notification_no"), raw["sr_no"], raw["survey"], raw["decision"]).alias("row_hash"),
        F.nullif(reasons, F.lit("")).alias("review_reason"),
        F.struct("span_id", "table_seq", "record_id").alias("row_seq"),
    )


def plots(rows: DataFrame) -> DataFrame:
    """One row per survey number of each application row."""
    each = sc.explode_surveys(rows.select("gazette_id", "notification_no", "sr_no", "village", "taluka", F.col("survey_raw").alias("_raw")), F.col("_raw"))
    key = sc.plot_hash(F.col("gazette_id"), F.col("notification_no"), F.col("sr_no"), F.col("survey_number"))
    return each.withColumn("row_hash", key).select(*schemas.PLOT_COLUMNS)


def row_issues(rows: DataFrame) -> DataFrame:
    """Adds ``issues`` (array of reasons) to every row, in rule order; the second and later row of
    one serial number in a notification is a duplicate."""
    sr = sc.validation_sr(F.col("sr_no"))
    same = Window.partitionBy("gazette_id", "notification_no", "_sr").orderBy("row_seq")
    missing = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    numbered = rows.withColumn("_sr", sr).withColumn("_again", F.col("_sr").isNotNull() & (F.row_number().over(same) > 1))
    reasons = F.array(
        F.when(~missing("review_reason"), F.col("review_reason")),
        F.when(missing("survey_raw"), "Missing survey numbers"),
        F.when(missing("taluka"), "Missing taluka").when(~sc.is_known_taluka(F.col("taluka")), F.concat(F.lit("Unknown taluka: "), F.col("taluka"))),
        F.when(F.col("_again"), F.concat(F.lit("Duplicate sr_no "), F.col("_sr").cast("string"))),
    )
    return numbered.withColumn("issues", F.array_compact(reasons)).drop("_sr", "_again")


def gap_issues(rows: DataFrame) -> DataFrame:
    """The first gap of each notification's serial numbers, as a warning."""
    keys = ["gazette_id", "notification_no"]
    numbers = rows.select(*keys, sc.validation_sr(F.col("sr_no")).alias("n")).where(F.col("n").isNotNull()).distinct()
    gaps = numbers.withColumn("before", F.lag("n").over(Window.partitionBy(*keys).orderBy("n"))).where(F.col("n") != F.col("before") + 1)
    first = gaps.groupBy(*keys).agg(F.min(F.struct("n", "before")).alias("g"))
    name = F.coalesce(F.nullif("notification_no", F.lit("")), F.lit("unknown"))
    text = F.concat(
        F.lit("Non-monotonic sr_no sequence gap between "), F.col("g.before").cast("string"), F.lit(" and "), F.col("g.n").cast("string"), F.lit(" (notification "), name, F.lit(")")
    )
    return first.select(*keys, text.alias("reason"))


def validate(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows (no error) and issues: ``gazette_id, notification_no, reason, severity, row``."""
    checked = row_issues(rows)
    good = checked.where(F.size("issues") == 0).drop("issues")
    columns = [c for c in schemas.APPLICATION_COLUMNS]
    errors = checked.select("gazette_id", "notification_no", F.explode("issues").alias("reason"), F.lit("error").alias("severity"), F.struct(*columns).alias("row"))
    kind = errors.schema["row"].dataType
    warnings = gap_issues(rows).select("gazette_id", "notification_no", "reason", F.lit("warning").alias("severity"), F.lit(None).cast(kind).alias("row"))
    return good, errors.unionByName(warnings)


def tagged_records(rows: DataFrame, plot_rows: DataFrame, issues: DataFrame) -> DataFrame:
    """``kind`` and JSON ``payload`` of rows, plots and review lines."""
    blank = lambda c: F.when(F.col("row").isNull(), F.lit("")).otherwise(F.col(f"row.{c}"))
    keep = {"ignoreNullFields": "false"}
    review = issues.select("reason", "severity", blank("gazette_id").alias("gazette_id"), blank("sr_no").alias("sr_no"), blank("survey_raw").alias("survey_raw"))
    tag = lambda kind, df, cols: df.select(F.lit(kind).alias("kind"), F.to_json(F.struct(*cols), keep).alias("payload"))
    return (
        tag("rows", rows, schemas.APPLICATION_COLUMNS).unionByName(tag("plots", plot_rows, schemas.PLOT_COLUMNS)).unionByName(tag("review", review, review.columns))
    )


def digest(rows: DataFrame, issues: DataFrame, top: int = 20) -> DataFrame:
    """One line of figures and texts per gazette: what a notifier sends."""
    line = F.concat_ws(
        " | ", F.concat(F.lit("- "), F.coalesce(F.nullif("sr_no", F.lit("")), F.lit("?"))), F.coalesce(F.nullif("applicant", F.lit("")), F.lit("N/A")),
        F.concat(F.coalesce("village", F.lit("")), F.lit(", "), F.coalesce("taluka", F.lit(""))), F.coalesce("decision", F.lit("")),
    )
    place = Window.partitionBy("gazette_id").orderBy("row_seq")
    numbered = rows.select("gazette_id", "row_seq", line.alias("line")).withColumn("k", F.row_number().over(place))
    # only the first lines are gathered, so a long gazette does not make a long row
    listed = numbered.groupBy("gazette_id").agg(
        F.count("*").alias("n_rows"), F.transform(F.array_sort(F.collect_list(F.when(F.col("k") <= top, F.struct("k", "line")))), lambda x: x["line"]).alias("lines")
    )
    where = F.when(
        F.col("row").isNotNull(),
        F.concat(F.lit(" — notification "), F.coalesce(F.nullif("row.notification_no", F.lit("")), F.lit("?")), F.lit(", Sr. "), F.coalesce(F.nullif("row.sr_no", F.lit("")), F.lit("?"))),
    ).otherwise("")
    text = F.concat(F.lit("- ["), F.col("severity"), F.lit("] "), F.col("reason"), where)
    at = Window.partitionBy("gazette_id").orderBy("severity", "text")
    said = issues.select("gazette_id", "severity", text.alias("text")).withColumn("k", F.row_number().over(at))
    review = said.groupBy("gazette_id").agg(
        F.count("*").alias("n_issues"),
        F.count_if(F.col("severity") == "error").alias("n_errors"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("k") <= top, F.struct("k", "text")))), lambda x: x["text"]).alias("review_lines"),
    )
    both = listed.join(review, "gazette_id", "full")
    n_rows, n_issues = F.coalesce("n_rows", F.lit(0)), F.coalesce("n_issues", F.lit(0))
    none = F.array().cast("array<string>")
    subject = F.when(n_rows > 0, F.format_string("Gazette 39A — %d new application(s)", n_rows)).otherwise(F.format_string("Gazette 39A — %d issue(s) need review", n_issues))
    more = lambda n: F.when(n > top, F.array(F.format_string("... and %d more", n - top))).otherwise(none)
    return both.select(
        "gazette_id",
        n_rows.alias("n_rows"),
        n_issues.alias("n_issues"),
        F.coalesce("n_errors", F.lit(0)).alias("n_errors"),
        (n_issues - F.coalesce("n_errors", F.lit(0))).alias("n_warnings"),
        subject.alias("subject"),
        F.concat(F.coalesce("lines", none), more(n_rows)).alias("lines"),
        F.concat(F.coalesce("review_lines", none), more(n_issues)).alias("review_lines"),
    )
