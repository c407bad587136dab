"""A named set of tables: a catalog schema, a directory of parquet, or DataFrames."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelint import model
from carelint.functions import expr as E
from carelint.functions import rows as R

_LENGTH = re.compile(r"\((\d+)\)")


class TableSource:
    """Tables by upper-case name.  A table is opened when it is first asked for."""

    def __init__(self, spark: SparkSession, openers: Mapping[str, Callable[[], DataFrame]],
                 lengths: Mapping[tuple[str, str], int] | None = None) -> None:
        self.spark = spark
        self._openers = {name.upper(): opener for name, opener in openers.items()}
        self._frames: dict[str, DataFrame] = {}
        self._lengths = {(t.upper(), c.upper()): n for (t, c), n in (lengths or {}).items()}

    # ------------------------------------------------------------------ constructors
    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
                    lengths: Mapping[tuple[str, str], int] | None = None) -> TableSource:
        openers = {n: (f if callable(f) and not isinstance(f, DataFrame) else (lambda f=f: f)) for n, f in frames.items()}
        return cls(spark, openers, lengths)

    @classmethod
    def from_parquet_dir(cls, spark: SparkSession, path: str,
                         lengths: Mapping[tuple[str, str], int] | None = None) -> TableSource:
        """Each ``<name>.parquet`` (file or folder) or folder ``<name>`` is a table."""
        base = spark._jvm.org.apache.hadoop.fs.Path(path)
        listing = base.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(base)
        openers = {}
        for entry in listing:
            name = entry.getPath().getName()
            if name.startswith((".", "_")) or not (entry.isDirectory() or name.endswith(".parquet")):
                continue
            where = entry.getPath().toString()
            openers[name.removesuffix(".parquet")] = lambda where=where: spark.read.parquet(where)
        return cls(spark, openers, lengths)

    @classmethod
    def from_catalog(cls, spark: SparkSession, schema: str) -> TableSource:
        """All tables and views of a schema, with the declared char/varchar lengths."""
        openers, lengths = {}, {}
        for table in spark.catalog.listTables(schema):
            if table.isTemporary:
                continue
            full = f"{schema}.`{table.name}`"
            openers[table.name] = lambda full=full: spark.table(full)
            # DESCRIBE is where the declared char and varchar types are still visible.
            for column in spark.sql(f"DESCRIBE TABLE {full}").collect():
                found = _LENGTH.search(column.data_type) if "char" in column.data_type.lower() else None
                if found:
                    lengths[(table.name, column.col_name)] = int(found.group(1))
        return cls(spark, openers, lengths)

    def with_frames(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame] | None]) -> TableSource:
        """A copy with some tables replaced, added, or (None) removed."""
        openers = dict(self._openers)
        for name, frame in frames.items():
            if frame is None:
                openers.pop(name.upper(), None)
            elif callable(frame) and not isinstance(frame, DataFrame):
                openers[name.upper()] = frame
            else:
                openers[name.upper()] = lambda frame=frame: frame
        return TableSource(self.spark, openers, self._lengths)

    def with_parsed_dates(self, formats: tuple[str, ...]) -> TableSource:
        """A copy whose text columns that the checks read as dates are parsed.

        ISO dates are read anyway; this is for sources that store other formats.  Structure
        checks should look at the source as it is.
        """
        def parsed(table: str) -> DataFrame:
            df = self.frame(table)
            texts = [c for c in df.columns if c.upper() in model.ALL_DATE_COLUMNS and E.is_string(df, c)]
            return df.withColumns({c: E.date_of(df, c, formats) for c in texts}) if texts else df

        return self.with_frames({t: (lambda t=t: parsed(t)) for t in self.names()})

    # ------------------------------------------------------------------------ lookup
    def names(self) -> list[str]:
        return sorted(self._openers)

    def frame(self, table: str) -> DataFrame:
        table = table.upper()
        if table not in self._frames:
            self._frames[table] = self._openers[table]()
        return self._frames[table]

    def columns(self, table: str) -> list[str]:
        return [c.upper() for c in self.frame(table).columns]

    def has(self, table: str, *columns: str) -> bool:
        if table.upper() not in self._openers:
            return False
        return not columns or set(c.upper() for c in columns) <= set(self.columns(table))

    # ---------------------------------------------------------------------- manifest
    def manifest(self, tables: Iterable[str] | None = None, lengths: str = "declared",
                 columns: Iterable[str] | None = None) -> DataFrame:
        """(table_name, column_name, data_type, char_max_len) of every column.

        ``declared`` uses the lengths the source was given (a catalog's char/varchar, or a
        caller's manifest), then those of char/varchar columns in the schema, and leaves the others
        null; ``observed`` measures the longest value of each string column, one scan per table
        and one small shuffle for all.
        """
        names = [t for t in self.names() if tables is None or t in set(tables)]
        wanted = None if columns is None else set(columns)

        def fields(table):
            return [f for f in self.frame(table).schema.fields if wanted is None or f.name.upper() in wanted]

        if lengths == "declared":
            data = [(t, f.name.upper(), _type_name(f.dataType), self._lengths.get((t, f.name.upper()), _declared(f)))
                    for t in names for f in fields(t)]
            return R.literal_table(self.spark, ["table_name", "column_name", "data_type", "char_max_len"], data,
                                   ["string", "string", "string", "int"])
        # All tables in one stage: lengths sit side by side, padded to the widest table.
        texts = {t: [f for f in fields(t) if _is_text(f.dataType)] for t in names}
        width = max((len(fs) for fs in texts.values()), default=0)
        none = F.lit(None).cast("int")
        layout, parts = [], []
        for i, t in enumerate(names):
            position = {f.name: j for j, f in enumerate(texts[t])}
            layout += [(i, position.get(f.name), t, f.name.upper(), _type_name(f.dataType)) for f in fields(t)]
            if texts[t]:
                lengths_of = [F.length(f.name) for f in texts[t]] + [none] * (width - len(texts[t]))
                parts.append(self.frame(t).select(F.lit(i).alias("t"), *[c.alias(f"l{j}") for j, c in enumerate(lengths_of)]))
        listing = R.literal_table(self.spark, ["t", "j", "table_name", "column_name", "data_type"], layout,
                                  ["int", "int", "string", "string", "string"])
        if not parts:
            return listing.select("table_name", "column_name", "data_type", none.alias("char_max_len"))
        longest = R.union_all(parts).groupBy("t").agg(*[F.max(f"l{j}").alias(f"l{j}") for j in range(width)])
        longest = longest.select("t", F.array(*[f"l{j}" for j in range(width)]).alias("longest"))
        return listing.join(longest, "t", "left").select(
            "table_name", "column_name", "data_type", F.get("longest", F.col("j")).alias("char_max_len"))


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.CharType, T.VarcharType))


def _declared(field: T.StructField) -> int | None:
    """The length of a char or varchar column, as Spark keeps it in the field's type or metadata."""
    if isinstance(field.dataType, (T.CharType, T.VarcharType)):
        return field.dataType.length
    found = _LENGTH.search(field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", ""))
    return int(found.group(1)) if found else None


def _type_name(kind: T.DataType) -> str:
    return "VARCHAR" if _is_text(kind) else kind.simpleString().upper()
