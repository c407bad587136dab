"""Reference tables: their schemas, the two views on the data-model workbook, JSON in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelint.functions import expr as E

# ------------------------------------------------------------- fixed values: schemas
_WORKBOOK = (
    "SHEET_NAME string, ROW_NUM decimal(38,0), CDM_VERSION string, CHANGED_IN_THIS_VERSION string, COMMENTS string, "
    "CONSTRAINT_TEXT string, CONSTRAINT_ORDER string, CONTACT string, DATA_FORMAT string, DOMAIN_DESCRIPTION string, "
    "DOMAIN_ORDER string, FIELD_DEFINITION string, FIELD_NAME string, FIELD_ORDER string, FILE_DATE string, "
    "RDBMS_DATA_TYPE string, RELATION_NAME string, RELATIONAL_INTEGRITY_DETAILS string, RELATION_ORDER string, "
    "REPLICATED_FIELD string, SAS_DATA_TYPE string, TABLE_NAME string, UNIT_OF_MEASURE string, VALUESET string, "
    "VALUESET_ITEM string, VALUESET_ITEM_DESCRIPTOR string, VALUESET_ITEM_ORDER string"
)
SCHEMAS = {
    "CDM_PARSEABLE_RAW": _WORKBOOK,
    "LOINC_REF_RAW": "LOINC_NUM string, PANEL_TYPE string, LONG_COMMON_NAME string, CLASSTYPE string, SOURCE_FILE string, "
                     "LOADED_AT timestamp_ntz",
    "REQUIRED_STRUCTURE_RAW": "MEMNAME string, NAME string, R_TYPE string, R_LENGTH string, CURRENT_VERSION string, "
                              "QUERY_PACKAGE string",
    "RXNORM_CUI_REF_RAW": "RXNORM_CUI decimal(38,0), CODE decimal(38,0), CODE_CLEAN decimal(38,0), CODETYPE string, "
                          "CODETYPE_CDM string, RXNORM_CUI_TTY string, RXNORM_CUI_TIER string, QUERY_PACKAGE string, "
                          "MVAR string, DIAGNOSIS decimal(38,0), PROCEDURES decimal(38,0), LAB_RESULT_CM decimal(38,0), "
                          "OBS_CLIN decimal(38,0), MED_ADMIN decimal(38,0), PRESCRIBING decimal(38,0), DISPENSING decimal(38,0)",
    "TBL_IVI_REF_RAW": "DESCRIPTION string, SOURCE_TABLE_ROW string, CODE_CRITERIA string, RESULT_NUM_CRITERIA string, "
                       "RESULT_MODIFIER_CRITERIA string, OTHER_CRITERIA string, QUERY_PACKAGE string",
    "CHECK_REGISTRY": "CHECK_ID string, CHECK_NAME string, ROW_NUM decimal(10,2), ROW_NUM_STR string, PART string, "
                          "EDC_TABLE string, DESCRIPTION string, PROC_NAME string, SOURCE_TABLES array<string>, ENABLED boolean, "
                          "ROW_NUM_CANON string, DOC_SUMMARY string, DOC_RUN string, DOC_OUTPUT string, "
                          "DOC_INTERPRETATION string, METRICS array<string>, EXCEPTION_METRICS array<string>, THRESHOLDS variant",
}


def valuesets_view(workbook: DataFrame) -> DataFrame:
    """Allowed values of each field, from the workbook's VALUESETS sheet."""
    return workbook.filter(
        (F.upper("SHEET_NAME") == "VALUESETS") & F.col("TABLE_NAME").isNotNull() & F.col("FIELD_NAME").isNotNull()
        & F.col("VALUESET_ITEM").isNotNull()
    ).select(
        E.norm(F.col("TABLE_NAME")).alias("TABLE_NAME"), E.norm(F.col("FIELD_NAME")).alias("FIELD_NAME"),
        F.trim("VALUESET_ITEM").alias("VALUESET_ITEM"), "VALUESET_ITEM_DESCRIPTOR",
        F.col("VALUESET_ITEM_ORDER").try_cast("decimal(38,0)").alias("VALUESET_ITEM_ORDER"),
        "CHANGED_IN_THIS_VERSION", F.col("SHEET_NAME").alias("SOURCE_SHEET"), F.col("ROW_NUM").alias("SOURCE_ROW_NUM"))


def constraints_view(workbook: DataFrame) -> DataFrame:
    """Constraint texts of each field, from the workbook's CONSTRAINTS sheet."""
    return workbook.filter(
        (F.upper("SHEET_NAME") == "CONSTRAINTS") & F.col("TABLE_NAME").isNotNull() & F.col("FIELD_NAME").isNotNull()
        & F.col("CONSTRAINT_TEXT").isNotNull()
    ).select(
        E.norm(F.col("TABLE_NAME")).alias("TABLE_NAME"), E.norm(F.col("FIELD_NAME")).alias("FIELD_NAME"), "CONSTRAINT_TEXT",
        "CONSTRAINT_ORDER", "CHANGED_IN_THIS_VERSION", F.col("SHEET_NAME").alias("SOURCE_SHEET"),
        F.col("ROW_NUM").alias("SOURCE_ROW_NUM"))


def _opened(text: Column) -> Column:
    """How many objects open in a text without escapes that starts outside of a string."""
    bare = F.regexp_replace(text, r'"[^"]*("|\z)', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit("{"), F.lit("")))


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """(value) The objects of JSON arrays, one a row, however the files are laid out in lines.

    Files are read in pieces that end at closing braces, by as many tasks as they have blocks (a gzip
    file is one block).  Whether a piece starts within a string and how deep it lies follows from the
    pieces before it: quotes and braces are summed up in every block for either start, blocks are
    put in order by their sums alone, and the pieces of one object meet by its number.  What stands
    between objects is no row; a last object without its closing brace is read as if it had it.
    """
    block = ["file", "block"]
    bare = F.regexp_replace("value", r"\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value", (quotes % 2).alias("odd"),
        _opened(bare).alias("open0"), _opened(F.concat(F.lit('"'), bare)).alias("open1"))
    inside = Window.partitionBy(*block).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    through = inside.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))

    def change(start: int) -> Column:
        """What a piece adds to the depth if its block starts outside (0) or within (1) a string; its brace counts only outside."""
        within = (F.col("turned") + start) % 2 == 1
        closes = (F.col("turned") + F.col("odd") + start) % 2 == 0
        return F.when(within, F.col("open1")).otherwise(F.col("open0")) - closes.cast("int")

    read = pieces.withColumn("turned", sum_of("odd", inside)).withColumns({"add0": change(0), "add1": change(1)})
    sums = read.groupBy(*block).agg(F.sum("odd").alias("odd"), F.sum("add0").alias("add0"), F.sum("add1").alias("add1"))
    states = sums.withColumn("start", sum_of("odd", earlier) % 2).withColumn("add", F.when(F.col("start") == 1, F.col("add1")).otherwise(F.col("add0")))
    states = states.select(*block, "start", sum_of("add", earlier).alias("above"))
    placed = read.join(states, block)
    own = F.when(F.col("start") == 1, F.col("add1")).otherwise(F.col("add0"))
    outside = (F.col("turned") + F.col("odd") + F.col("start")) % 2 == 0
    ended = placed.withColumn("depth", F.col("above") + F.sum(own).over(through)).select(
        *block, "at", "value", (outside & (F.col("depth") == 0)).cast("int").alias("ends"))
    counts = ended.groupBy(*block).agg(F.sum("ends").alias("n")).select(*block, sum_of("n", earlier).alias("before"))
    numbered = ended.join(counts, block).withColumn("number", F.col("before") + sum_of("ends", inside))
    whole = numbered.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    text = F.concat(F.array_join(F.col("parts.value"), "}"), F.lit("}"))
    return whole.select(F.regexp_replace(text, r"\A[^{]*", "").alias("value")).where("value != '' and startswith(value, '{')")


def load_reference_json(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A JSON array of row objects (plain or gzip) as the typed reference table.

    Values are read as text where the target is text, and parsed where it is not: columns a
    row lacks are null.  A registry's variant column keeps its JSON.
    """
    schema = T._parse_datatype_string(SCHEMAS[table.upper()])
    variants = [f.name for f in schema.fields if isinstance(f.dataType, T.VariantType)]
    raw = T.StructType([T.StructField(f.name, T.StringType()) if f.name in variants else f for f in schema.fields])
    df = json_objects(spark, path).select(F.from_json("value", raw).alias("row")).select("row.*")
    return df.select(*[F.try_parse_json(f.name).alias(f.name) if f.name in variants else F.col(f.name) for f in schema.fields])


def replace_reference(df: DataFrame, path: str) -> None:
    """Replace a stored reference table's contents."""
    df.write.mode("overwrite").parquet(path)


def export_reference_json(df: DataFrame, path: str) -> None:
    """A reference table as JSON lines; a variant column is written as its JSON text."""
    text = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.VariantType) else F.col(f.name) for f in df.schema.fields]
    df.select(*text).write.mode("overwrite").json(path)
