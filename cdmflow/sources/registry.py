"""Registry sources: the wide form export (CSV) and the stand-in derived from the driver tables."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import quoted
from ..operators.lookup import lookup_join
from .dictionary import rename_labels

NUMERIC_FIELDS = ("cardiac_t2", "liver_mri_t2", "ferritin_result", "iron_result")
TEXT_FIELDS = (
    "date_of_birth", "gender", "country_of_birth", "orpha_code_id", "transfusion_status_present",
    "varsid_hbb_a1", "varsid_hbb_a2", "varsid_hba_a1", "varsid_hba_a2", "endo_hypopit", "was_pregnant",
    "lkd_ac_vir_hepat", "endo_vit_d_def", "lkd_cirrhosis", "bc_osteoporosis", "bc_osteopenia",
    "cpd_ac_chest_syn", "chelation_treat", "hydroxyurea_treatment", "drug_compliance", "splenectomy",
    "patient_status", "consent_registry",
)
REGISTRY_FIELDS = ("record_id",) + TEXT_FIELDS + NUMERIC_FIELDS

REGISTRY_SCHEMA = T.StructType(
    [T.StructField("record_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in TEXT_FIELDS]
    + [T.StructField(c, T.DoubleType()) for c in NUMERIC_FIELDS]
)


# The words that stand for a missing value in registry exports.
NA_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
            "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def clean_export(raw: DataFrame) -> DataFrame:
    """Text columns of an export without the carriage return of a CRLF line end and with NA words as NULL."""
    text = {c: F.regexp_replace(F.col(quoted(c)), "\r$", "") for c in raw.columns}
    return raw.select(*[F.when(~v.isin(*NA_WORDS), v).alias(c.rstrip("\r")) for c, v in text.items()])


def type_registry(raw: DataFrame) -> DataFrame:
    """Typed staging: numbers parsed tolerantly (bad text -> NULL, see quality.bad_numbers).

    The record id stays the exact text of the export (leading zeros, letters); keys order
    numeric ids numerically and text ids after them. Missing columns are added as NULL so
    every rule has its input.
    """
    cols = []
    for f in REGISTRY_SCHEMA.fields:
        if f.name == "record_id" and f.name in raw.columns:
            cols.append(F.col(f.name).cast("string").alias(f.name))
        elif f.name in raw.columns:
            c = F.col(f.name)
            cols.append((c.try_cast(f.dataType) if f.dataType != T.StringType() else c.cast("string")).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in raw.columns if c not in REGISTRY_SCHEMA.fieldNames()]
    return raw.select(*cols, *[F.col(quoted(c)) for c in extra])


_CSV = {"quote": '"', "escape": '"', "encoding": "UTF-8"}


def profile_export(spark: SparkSession, path: str) -> DataFrame:
    """(file, first_line, odd_lines) of every file of an export, in one splittable pass.

    ``odd_lines`` counts the lines with an odd number of quotes: where a record begins or ends that spans lines.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.groupBy("file").agg(F.min_by("value", "place").alias("first_line"),
                                     F.count_if(quotes % 2 == 1).alias("odd_lines"))


def read_header(spark: SparkSession, file: str) -> tuple[list[str], list[str]]:
    """(column names, physical lines) of the header record of one file; the record may span lines.

    Only the record itself is read: the CSV reader stops after it, the lines come from the file's first block.
    """
    first = spark.read.options(header=False, multiLine=True, **_CSV).csv(file).limit(1).collect()
    if not first:
        return [], []
    names = [(v or f"_c{i}").lstrip("\ufeff").rstrip("\r") for i, v in enumerate(first[0])]
    names = [f"{n}{i}" if names.count(n) > 1 else n for i, n in enumerate(names)]
    size = 1 + sum((v or "").count("\n") for v in first[0])
    lines = spark.read.text(file).filter("_metadata.file_block_start = 0").limit(size).collect()
    return names, [r["value"] for r in lines]


def _body(spark: SparkSession, files: list[str], names: list[str], head: list[str]) -> DataFrame:
    """The records below the header, each on a line of its own: the scan splits like any text file."""
    lines = spark.read.text(files).filter(~F.col("value").isin(head) & (F.trim("value") != ""))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    return lines.select(F.from_csv("value", schema, _CSV).alias("r")).select("r.*").toDF(*names)


def read_registry_text(spark: SparkSession, path: str | list[str], labels: dict[str, str] | None = None,
                       multiline: bool | None = None) -> DataFrame:
    """Scan label-headed registry exports (a file, folder or pattern) as text and rename labels to variables.

    Every file is read by its own header, so exports may differ in the order and choice of columns; a column that a
    file lacks is NULL. Everything is read as string (no inference pass over the data), so a dirty value cannot
    change a column's type; what does not parse can be listed before typing.

    Line breaks inside values make a file unsplittable: one task must read it from its start. With ``multiline``
    None, a pass over the lines finds out which files hold such records, and only those are read whole; True reads
    every file whole without looking; False raises an error for a file that would need it.
    """
    by_header: dict[str, list] = {}
    for r in profile_export(spark, path).collect():  # one row per file
        by_header.setdefault(r["first_line"], []).append(r)
    parts = []
    for rows in by_header.values():
        rows.sort(key=lambda r: r["file"])
        names, head = read_header(spark, rows[0]["file"])
        in_head = sum(line.count('"') % 2 for line in head)
        spanning = [r["file"] for r in rows if multiline or r["odd_lines"] > in_head]
        if spanning and multiline is False:
            raise ValueError(f"records span lines in {spanning[0]}; read it with multiline=True")
        plain = [r["file"] for r in rows if r["file"] not in spanning]
        if plain:
            parts.append(_body(spark, plain, names, head))
        if spanning:
            parts.append(spark.read.options(header=True, multiLine=True, inferSchema=False, **_CSV).csv(spanning).toDF(*names))
    if not parts:
        return spark.createDataFrame([], "record_id string")
    cleaned = [rename_labels(clean_export(p), labels) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cleaned)


def read_registry_csv(spark: SparkSession, path: str, labels: dict[str, str] | None = None) -> DataFrame:
    """The typed registry of a label-headed export."""
    return type_registry(read_registry_text(spark, path, labels))


# ---------------------------------------------------------------------------
# Stand-in registry: one record per order (orders x customer x nation). The
# expressions are valid in both Spark SQL and DuckDB so the oracle derives the
# very same rows; the birth date is the one place where the dialects differ.
# ---------------------------------------------------------------------------
def _ladder(key: str, mod: int, steps: list[tuple[int, str]]) -> str:
    parts = " ".join(f"WHEN {key} % {mod} < {hi} THEN '{v}'" for hi, v in steps)
    return f"CASE {parts} END"


_YES_CONFIRMED = "Yes, confirmed"
FIXTURE_EXPRS: dict[str, str] = {
    "record_id": "o_orderkey",
    "gender": "CASE WHEN o_orderkey % 7 < 3 THEN 'Male' WHEN o_orderkey % 7 < 6 THEN 'Female' "
              "ELSE 'Undetermined' END",
    "country_of_birth": "CASE n_nationkey % 10 WHEN 0 THEN 'Australia' WHEN 1 THEN 'Canada' WHEN 2 THEN 'Congo' "
                        "WHEN 3 THEN 'Cyprus' WHEN 4 THEN 'Greece' WHEN 5 THEN 'Iraq' WHEN 6 THEN 'Syria' "
                        "WHEN 7 THEN 'United Kingdom' WHEN 8 THEN 'France' END",
    "orpha_code_id": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Alpha-thalassemia' "
                     "WHEN 'BUILDING' THEN 'Beta-thalassemia' WHEN 'FURNITURE' THEN 'Sickle cell disease' "
                     "WHEN 'HOUSEHOLD' THEN 'Hemoglobin C disease' END",
    "transfusion_status_present": "CASE o_orderkey % 5 WHEN 0 THEN 'Yes (Regular)' "
                                  "WHEN 1 THEN 'Yes (Occasional)' WHEN 2 THEN 'No' WHEN 3 THEN 'Unknown' END",
    "varsid_hbb_a1": "CASE o_orderkey % 4 WHEN 0 THEN 'b+' WHEN 1 THEN 'b++' WHEN 2 THEN 'b0' END",
    "varsid_hbb_a2": "CASE o_custkey % 4 WHEN 0 THEN 'b0' WHEN 1 THEN 'b+' WHEN 3 THEN 'b++' END",
    "varsid_hba_a1": "CASE o_orderkey % 3 WHEN 0 THEN 'a+' WHEN 1 THEN 'a0' END",
    "varsid_hba_a2": "CASE o_custkey % 3 WHEN 1 THEN 'a+' WHEN 2 THEN 'a0' END",
    "endo_hypopit": _ladder("o_orderkey", 13, [(1, "Yes"), (2, _YES_CONFIRMED), (3, "Clinical suspicion"),
                                               (6, "No"), (7, "Unknown")]),
    "was_pregnant": _ladder("o_orderkey", 17, [(3, "Yes"), (11, "No"), (14, "Unknown")]),
    "lkd_ac_vir_hepat": _ladder("o_orderkey", 19, [(2, "Yes"), (4, _YES_CONFIRMED), (6, "Clinical suspicion"),
                                                   (14, "No"), (17, "Unknown")]),
    "endo_vit_d_def": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes, confirmed' "
                      "WHEN '2-HIGH' THEN 'Clinical suspicion' WHEN '3-MEDIUM' THEN 'No' "
                      "WHEN '4-NOT SPECIFIED' THEN 'Unknown' END",
    "lkd_cirrhosis": _ladder("o_orderkey", 23, [(3, _YES_CONFIRMED), (6, "Clinical suspicion"), (17, "No"),
                                                (20, "Unknown")]),
    "bc_osteoporosis": _ladder("o_orderkey", 29, [(4, _YES_CONFIRMED), (8, "Clinical suspicion"), (22, "No"),
                                                  (26, "Unknown")]),
    "bc_osteopenia": _ladder("o_orderkey", 31, [(5, _YES_CONFIRMED), (9, "Clinical suspicion"), (24, "No"),
                                                (28, "Unknown")]),
    "cpd_ac_chest_syn": _ladder("o_orderkey", 37, [(3, _YES_CONFIRMED), (7, "Clinical suspicion"), (30, "No"),
                                                   (34, "Unknown")]),
    "chelation_treat": "CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' ELSE 'Unknown' END",
    "hydroxyurea_treatment": "CASE o_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END",
    "drug_compliance": "CASE o_orderkey % 8 WHEN 0 THEN 'Excellent (>80% of recommended dose)' "
                       "WHEN 1 THEN 'Good (80-60 % of recommended dose)' "
                       "WHEN 2 THEN 'Poor (< 60% of recommended dose)' WHEN 3 THEN 'Unknown' END",
    "splenectomy": "CASE o_custkey % 10 WHEN 0 THEN 'Yes, totally' WHEN 1 THEN 'Yes, partially' "
                   "WHEN 7 THEN 'Unknown' WHEN 8 THEN NULL ELSE 'No' END",
    "patient_status": "CASE o_orderkey % 9 WHEN 0 THEN 'Dead' WHEN 1 THEN 'Opted-out' "
                      "WHEN 2 THEN 'Lost in follow-up' ELSE 'Alive' END",
    "consent_registry": "CASE WHEN o_orderkey % 97 = 5 THEN NULL ELSE 'Yes' END",
    "cardiac_t2": "CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice / 10000 END",
    "liver_mri_t2": "CASE WHEN o_orderkey % 6 <> 1 THEN o_totalprice / 5000 END",
    "ferritin_result": "CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 100 END",
    "iron_result": "CASE WHEN o_custkey % 5 <> 2 THEN c_acctbal / 10 END",
}
BAD_DATE_EXPR = "o_orderkey % 101 = 100"
DOB_SPARK = (f"CASE WHEN {BAD_DATE_EXPR} THEN '31/02/2000' ELSE date_format(date_add(DATE'1925-06-01', "
             "CAST(o_orderkey * 37 % 30000 AS INT)), 'dd/MM/yyyy') END")
DOB_DUCKDB = (f"CASE WHEN {BAD_DATE_EXPR} THEN '31/02/2000' ELSE strftime(DATE '1925-06-01' + "
              "CAST(o_orderkey * 37 % 30000 AS INTEGER), '%d/%m/%Y') END")


def fixture_select_list(dialect: str) -> list[tuple[str, str]]:
    """(column, expression) of the stand-in registry in REGISTRY_FIELDS order."""
    dob = DOB_SPARK if dialect == "spark" else DOB_DUCKDB
    exprs = dict(FIXTURE_EXPRS, date_of_birth=dob)
    return [(c, exprs[c]) for c in REGISTRY_FIELDS]


def derived_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the missing patient file: one typed registry row per order."""
    orders = spark.read.parquet(os.path.join(sf_dir, "orders.parquet")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    customer = spark.read.parquet(os.path.join(sf_dir, "customer.parquet")).select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = spark.read.parquet(os.path.join(sf_dir, "nation.parquet")).select("n_nationkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    joined = lookup_join(joined, nation, joined.c_nationkey == nation.n_nationkey)
    out = joined.select(*[F.expr(e).alias(c) for c, e in fixture_select_list("spark")])
    return out.select(*[F.col(f.name).cast(f.dataType) for f in REGISTRY_SCHEMA.fields])
