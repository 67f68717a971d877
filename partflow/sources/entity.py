"""Entity scans: column lists, filter strings, key lookups, paging, JSON pages, caching.

An entity source is anything with ``entity(name) -> DataFrame`` (the staged test
tables, or :class:`ParquetEntities` over a folder of one dataset per entity).
All operators return lazy DataFrames so Catalyst pushes the selected columns
and the predicates into the scan.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.functions.patterns import PAGE_SIZE
from partflow.session import checkpoint_dir


class ParquetEntities:
    """One parquet dataset per entity under ``root`` (``root/name``)."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType] | None = None):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), dict(schemas or {})

    def entity(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.parquet(f"{self.root}/{name}")


def split_fields(fields: str | Iterable[str]) -> list[str]:
    """``'a, b ,c'`` -> ``['a', 'b', 'c']`` (all spaces removed, as the API does)."""
    if isinstance(fields, str):
        return [f for f in fields.replace(" ", "").split(",") if f]
    return [f.replace(" ", "") for f in fields]


_FILTER = re.compile(r"^(?P<field>[^\[=]+)(\[(?P<op>gt|in)\])?=(?P<value>.*)$")


_ISO = re.compile(r"\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d+)?)?")


def after_time(col: str, start: str) -> Column:
    """ISO date-time text strictly after a time; text that is no time doesn't match.

    The plain text bound beside the exact condition (ISO text sorts as time does) reaches the scan, so
    row groups before the date are not read.
    """
    return (F.col(col) >= F.lit(start[:10])) & (F.try_to_timestamp(F.col(col)) > F.to_timestamp(F.lit(start)))


def _compared(df: DataFrame, field: str, op: str | None, value: str) -> Column:
    """Equality in the column's own type; ``[gt]`` on text with an ISO date or date-time compares time."""
    dtype = df.schema[field].dataType
    if not isinstance(dtype, T.StringType):
        lit = F.lit(value).cast(dtype)
        return F.col(field) > lit if op == "gt" else F.col(field) == lit
    if op != "gt":
        return F.col(field) == F.lit(value)
    return after_time(field, value) if _ISO.fullmatch(value) else F.col(field) > F.lit(value)


def key_to_string(key) -> str | None:
    """A lookup key as the API writes it: whole numbers without a decimal point, text as it is."""
    if key is None or isinstance(key, str):
        return key
    return str(int(key)) if float(key).is_integer() else repr(float(key))


def filter_condition(df: DataFrame, filter_string: str) -> Column | None:
    """The API's filter grammar: ``f=v``, ``f[gt]=v`` (strict), ``f[in]=a|b``; ``&`` separates terms."""
    cond = None
    for term in [t for t in filter_string.split("&") if t]:
        m = _FILTER.match(term)
        if not m:
            raise ValueError(f"bad filter term: {term!r}")
        field, op, value = m.group("field").strip(), m.group("op"), m.group("value")
        if op == "in":
            col = F.col(field)
            dtype = df.schema[field].dataType
            c = col.isin([F.lit(v).cast(dtype) for v in value.split("|")])
        else:
            c = _compared(df, field, op, value)
        cond = c if cond is None else cond & c
    return cond


def entity_filter(df: DataFrame, filter_string: str) -> DataFrame:
    cond = filter_condition(df, filter_string)
    return df if cond is None else df.where(cond)


def lookup_in(df: DataFrame, field: str, keys, null_safe: bool = False, hashed: bool = False) -> DataFrame:
    """Rows whose ``field`` is in ``keys`` (a one-column DataFrame or a list): a left-semi join.

    No batching is needed: the keys are a distributed table. Spark chooses a
    broadcast of the key side only when AQE measures it below the threshold.
    ``hashed``: the keys of a partition go to a hash table, so that wide rows aren't sorted (and spilled) for them.
    """
    dtype = df.schema[field].dataType
    if not isinstance(keys, DataFrame):
        keys = df.sparkSession.createDataFrame([(key_to_string(k),) for k in keys], "k string")
    k = keys.select(keys.columns[0]).toDF("__key")
    k = k.select(F.col("__key").cast(dtype).alias("__key")).distinct()
    k = k.hint("shuffle_hash") if hashed else k
    cond = df[field].eqNullSafe(k["__key"]) if null_safe else df[field] == k["__key"]
    return df.join(k, cond, "left_semi")


def read_entity(source, name: str, fields: str | Iterable[str], search: Mapping | None = None,
                filter_string: str = "") -> DataFrame:
    """Scan one entity with a column list and either a key lookup or a filter string.

    As in the API, a lookup (``search``, first key only) wins over ``filter_string``.
    """
    df = source.entity(name).select(*split_fields(fields))
    if search:
        field, keys = next(iter(search.items()))
        return lookup_in(df, field, keys)
    if filter_string:
        return entity_filter(df, filter_string)
    return df


def page(df: DataFrame, order_by: Iterable[str], skip: int = 0, take: int = PAGE_SIZE) -> DataFrame:
    """One page of a totally ordered scan (``ORDER BY .. OFFSET skip LIMIT take``).

    Spark keeps the top ``skip + take`` rows per partition and merges them, so
    deep offsets grow with ``skip``; use :func:`page_after` to walk a large table.
    """
    return df.orderBy(*order_by).offset(skip).limit(take)


def page_after(df: DataFrame, order_by: Iterable[str], after: tuple | None = None,
               take: int = PAGE_SIZE) -> DataFrame:
    """Keyset paging: the ``take`` rows that follow the key tuple ``after`` in ``order_by`` order (nulls first).

    The "greater than the last key" predicate is a filter (pushed to the scan
    where possible), so every page costs the same whatever its position.
    """
    cols = list(order_by)
    if after is not None:
        cond = None
        for i in range(len(cols) - 1, -1, -1):
            c = F.col(cols[i])
            here = c.isNotNull() if after[i] is None else F.coalesce(c > F.lit(after[i]), F.lit(False))
            if cond is not None:
                here = here | (c.eqNullSafe(F.lit(after[i])) & cond)
            cond = here
        df = df.where(cond)
    return df.orderBy(*cols).limit(take)


def json_collection(df: DataFrame, col: str, schema: T.StructType | str, keep: Iterable[str] = ()) -> DataFrame:
    """Decode a JSON text column into columns; missing keys become null."""
    parsed = F.from_json(F.col(col), schema)
    return df.select(*keep, parsed.alias("__j")).select(*keep, "__j.*")


def json_pages(df: DataFrame, col: str, record_schema: T.StructType | str, data_key: str = "Data") -> DataFrame:
    """``{"Data": [ {...}, ... ]}`` page documents -> one row per record."""
    rec = record_schema if isinstance(record_schema, T.StructType) else T._parse_datatype_string(record_schema)
    page_schema = T.StructType([T.StructField(data_key, T.ArrayType(rec))])
    return (df.select(F.from_json(F.col(col), page_schema).alias("__p"))
            .select(F.explode(f"__p.{data_key}").alias("__r")).select("__r.*"))


def employees(source) -> DataFrame:
    return read_entity(source, "employees", "employeeCode,employeeName,active,departmentNumber")


# CSV that gives back what was written: line breaks, quotes, padding, and empty text apart from null.
CSV_EXACT = {"header": "true", "multiLine": "true", "quoteAll": "true", "quote": '"', "escape": '"', "lineSep": "\n", "nullValue": "\u0000",
             "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a writer has committed the folder."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def materialize_once(df: DataFrame, name: str, key: str, root: str | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """Write ``df`` once under a path keyed by entity + predicate, then always read it back.

    ``key`` names the request (source and filter); with the columns and their types it gives the path, so another
    column list or filter gets another path. Only a folder that its writer has committed counts as
    there; what an interrupted writer left is written over.
    """
    if not key:
        raise ValueError("a key that names the source and the filter is needed")
    spark = df.sparkSession
    digest = hashlib.sha1(f"{key}|{df.schema.json()}".encode()).hexdigest()[:16]
    path = f"{(root or checkpoint_dir(spark) + '/entity-cache').rstrip('/')}/{name}-{digest}"
    options = CSV_EXACT if fmt == "csv" else {}
    if not _complete(spark, path):
        df.write.mode("overwrite").format(fmt).options(**options).save(path)
    return spark.read.format(fmt).schema(df.schema).options(**options).load(path)
