"""File sources and schema checks.

* ``read_trip_files``: recursive discovery of monthly Parquet files, column
  projection pushed into the scan, month taken from the file name
  (``_metadata.file_path``), a stable unique ``row_key`` per row.
* ``file_layouts`` / ``read_canonical``: files of several layouts as one table.
* ``canonical_columns``: alias-tolerant renaming (first present variant wins), a
  missing column raises; ``one_variant_per_file`` chooses per file.
* ``schema_findings``: per-column presence / type findings of a frame's schema;
  ``schema_findings_per_file``: of every file, before aliasing.
* ``single_file_check``: the monitoring source must be exactly one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.config import COLUMN_ALIASES, NUMERIC_COLUMNS, REQUIRED_COLUMNS, STRING_COLUMNS

MONTH_PATTERN = r"(\d{4})-(\d{2})\.parquet"


def _reader(spark: SparkSession, glob: str, recursive: bool, months: list[str] | None):
    if months:
        glob = "*{" + ",".join(months) + "}.parquet"
    return spark.read.option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", glob)


def file_layouts(spark: SparkSession, path: str, glob: str = "*.parquet", recursive: bool = True,
                 months: list[str] | None = None) -> list[tuple[list[str], T.StructType]]:
    """The files under ``path`` in groups whose footers merge to one schema.

    Spark reads the footers in parallel tasks.  Files that name their columns
    differently merge (each lacks the others' names); only a column with two
    types splits the list, by halves in name order until the halves merge."""
    files = sorted(_reader(spark, glob, recursive, months).parquet(path).inputFiles())

    def groups(part):
        try:
            return [(part, spark.read.option("mergeSchema", "true").parquet(*part).schema)]
        except Exception as ex:  # noqa: BLE001 - only a conflict of types is handled
            if len(part) == 1 or "MERGE" not in str(ex).upper():
                raise
        mid = len(part) // 2
        return groups(part[:mid]) + groups(part[mid:])

    out: list[tuple[list[str], T.StructType]] = []
    for part, schema in groups(files):
        for i, (have, known) in enumerate(out):
            if known == schema:
                out[i] = (have + part, known)
                break
        else:
            out.append((part, schema))
    return out


def _with_file_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    df = df.select(*[F.col(f"`{c}`") for c in columns], F.col("_metadata.file_path").alias("source_file"),
                   row_key().alias("row_key"))
    m = F.regexp_extract("source_file", MONTH_PATTERN, 0)
    return df.withColumn("month", F.when(m != "", F.substring(m, 1, 7)))


def read_trip_files(spark: SparkSession, path: str, columns: list[str] | None = None,
                    glob: str = "*.parquet", recursive: bool = True, months: list[str] | None = None) -> DataFrame:
    """All Parquet files under ``path`` with ``month`` (YYYY-MM) and ``source_file``,
    with the columns of all of them (null where a file lacks one).
    ``months`` prunes at file listing: only files named for those months are read.
    Files whose types conflict need :func:`read_canonical`."""
    layouts = file_layouts(spark, path, glob, recursive, months)
    if len(layouts) > 1:
        raise ValueError(f"{len(layouts)} file layouts with conflicting types under {path}; use read_canonical")
    files, schema = layouts[0]
    df = spark.read.schema(schema).parquet(*files)
    return _with_file_columns(df, columns or df.columns)


def read_canonical(spark: SparkSession, path: str, keep_extra: list[str] | None = None, strict: bool = True,
                   aliases: dict = COLUMN_ALIASES, required: list[str] = REQUIRED_COLUMNS, **options) -> DataFrame:
    """Trip files of any mixture of layouts as one canonical table: each group
    of files is read and renamed by its own schema, numbers become doubles, and
    the groups are united.  ``strict`` raises if a file has no value at all in
    a required column (its rows would vanish in the null rules later)."""
    parts = []
    for files, schema in file_layouts(spark, path, **options):
        df = spark.read.schema(schema).parquet(*files)
        try:
            merged = one_variant_per_file(_with_file_columns(df, df.columns), aliases, required)
            parts.append(canonical_columns(merged, aliases, required,
                                           keep_extra=list(dict.fromkeys(["source_file", *(keep_extra or [])]))))
        except ValueError as ex:
            raise ValueError(f"{ex} in {len(files)} files, such as {files[:3]}") from None
    kinds = {c: {type(p.schema[c].dataType) for p in parts} for c in required}
    for i, p in enumerate(parts):
        casts = {}
        for c in required:
            if len(kinds[c]) > 1:  # text and numbers, or text and timestamps, in different files
                numeric = any(issubclass(k, T.NumericType) for k in kinds[c])
                casts[c] = F.expr(f"try_cast(`{c}` AS double)") if numeric else F.col(c).cast("string")
        parts[i] = p.withColumns(casts) if casts else p
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if strict:
        lacking = [(r["source"], r["column"]) for r in presence_per_file(out, required).filter(~F.col("present")).limit(20).collect()]
        if lacking:
            raise ValueError(f"files without a required column: {lacking}")
    return out if keep_extra and "source_file" in keep_extra else out.drop("source_file")


def presence_per_file(df: DataFrame, columns: list[str], file_col: str = "source_file") -> DataFrame:
    """``(source, column, rows, values, present)``: one aggregation over the
    rows; a column is present in a file that has a value of it (or no row)."""
    agg = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("values")) for i, c in enumerate(columns)]
    return (agg.select(F.regexp_extract(file_col, r"([^/]+)$", 1).alias("source"), "rows", F.inline(F.array(*items)))
            .withColumn("present", (F.col("values") > 0) | (F.col("rows") == 0)))


def row_key():
    """A unique, stable row key for file rows: the MD5 of the file's path and
    the row's index in its Parquet file.  Unlike a hash of the values it
    separates identical rows, and unlike monotonically_increasing_id it is the
    same on every re-evaluation."""
    return F.concat(F.md5(F.col("_metadata.file_path").cast("string").cast("binary")), F.lit("-"),
                    F.col("_metadata.row_index").cast("string"))


def canonical_columns(df: DataFrame, aliases: dict = COLUMN_ALIASES, required: list[str] = REQUIRED_COLUMNS,
                      keep_extra: list[str] | None = None) -> DataFrame:
    """Rename the first present variant of each canonical column, then project
    the required columns (plus ``keep_extra``); a column without any variant
    raises."""
    present = set(df.columns)
    cols = []
    for canon in required:
        found = [v for v in aliases.get(canon, [canon]) if v in present]
        if not found:
            raise ValueError(f"no column for {canon!r} (looked for {aliases.get(canon, [canon])})")
        cols.append(F.col(f"`{found[0]}`").alias(canon))
    return df.select(*[F.col(c) for c in (keep_extra or []) if c in present], *cols)


def one_variant_per_file(df: DataFrame, aliases: dict = COLUMN_ALIASES, required: list[str] = REQUIRED_COLUMNS,
                         file_col: str = "source_file") -> DataFrame:
    """Files of several layouts read with merged columns: where a canonical
    column has several variants, each file's first one with a value goes under
    the canonical name's first variant (numbers as doubles, times as text, if
    the variants' types differ).  One aggregation with a row per file."""
    types = {f.name: f.dataType for f in df.schema.fields}
    several = {c: found for c in required if len(found := [v for v in aliases.get(c, [c]) if v in types]) > 1}
    if not several:
        return df
    pick = {c: F.coalesce(*[F.when(F.count(f"`{v}`") > 0, F.lit(i)) for i, v in enumerate(found)], F.lit(0)).alias(f"_ix_{c}")
            for c, found in several.items()}
    per = df.groupBy(F.col(file_col).alias("_ix_file")).agg(*pick.values())
    out = df.join(per, F.col(file_col) == F.col("_ix_file"))
    values = {}
    for c, found in several.items():
        kinds = {types[v] for v in found}
        if len(kinds) == 1:
            parts = [F.col(f"`{v}`") for v in found]
        elif any(isinstance(k, T.NumericType) for k in kinds):
            parts = [F.expr(f"try_cast(`{v}` AS double)") for v in found]
        else:
            parts = [F.col(f"`{v}`").cast("string") for v in found]
        values[found[0]] = F.coalesce(*[F.when(F.col(f"_ix_{c}") == i, x) for i, x in enumerate(parts)])
    return out.withColumns(values).drop("_ix_file", *[f"_ix_{c}" for c in several])


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.NumericType):
        return "numeric"
    if isinstance(t, T.StringType):
        return "string"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "timestamp"
    return t.simpleString()


def schema_findings(spark: SparkSession, df: DataFrame, numeric: list[str] = NUMERIC_COLUMNS,
                    strings: list[str] = STRING_COLUMNS, source: str = "input") -> DataFrame:
    """``(source, column, expected, actual, values, present, type_ok, status)``,
    one aggregation over the rows: ``values`` counts the rows with a value, and
    a column is present if the frame has it and any row has a value of it (or
    there are no rows).  A timestamp counts as a valid datetime column.
    Warnings only: callers decide."""
    types = {f.name: f.dataType for f in df.schema.fields}
    expected = [(c, "numeric") for c in numeric] + [(c, "string") for c in strings]
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[(F.count(F.col(f"`{c}`")) if c in types else F.lit(0).cast("long")).alias(f"_n{i}")
                                                     for i, (c, _) in enumerate(expected)])
    items = []
    for i, (c, exp) in enumerate(expected):
        act = _kind(types[c]) if c in types else None
        ok = act == exp or (exp == "string" and act == "timestamp")
        present = (F.lit(c in types)) & ((F.col(f"_n{i}") > 0) | (F.col("_rows") == 0))
        items.append(F.struct(F.lit(source).alias("source"), F.lit(c).alias("column"), F.lit(exp).alias("expected"),
                              F.lit(act).cast("string").alias("actual"), F.col(f"_n{i}").alias("values"), present.alias("present"),
                              F.lit(bool(ok)).alias("type_ok"), F.when(present & F.lit(bool(ok)), "ok").otherwise("warning").alias("status")))
    return agg.select(F.inline(F.array(*items)))


def single_file_check(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """One row: number of distinct source files and whether it is exactly one."""
    return df.agg(F.countDistinct(file_col).alias("n_files")).withColumn("ok", F.col("n_files") == 1)


def read_routes_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed CSV scan of a routes file (no schema inference)."""
    from farelane.operators.routes import ROUTES_SCHEMA
    return spark.read.schema(ROUTES_SCHEMA).option("header", True).csv(path)


def _metrics_rows(spark: SparkSession, path: str) -> DataFrame:
    """Flat ``{"candidate", "metric", "value"}`` rows, or one document per file
    with ``{candidate: {metric: value}}`` (other entries are passed over)."""
    docs = spark.read.text(path, wholetext=True).select(F.col("value").alias("doc"))
    flat = (spark.read.schema("candidate string, metric string, value double").json(path)
            .filter(F.col("candidate").isNotNull() & F.col("metric").isNotNull()))
    outer = docs.select(F.explode(F.from_json("doc", "map<string,string>")).alias("candidate", "inner"))
    nested = (outer.filter(F.col("inner").startswith("{"))
              .select("candidate", F.explode(F.from_json("inner", "map<string,string>")).alias("metric", "text"))
              .select("candidate", "metric", F.expr("try_cast(text AS double)").alias("value"))
              .filter(F.col("value").isNotNull()))
    return flat.unionByName(nested)


def read_metrics_json(spark: SparkSession, specific: str | None, combined: str | None) -> DataFrame:
    """Metrics ``(candidate, metric, value)``: rows from the specific file win
    over the combined file's rows for the same (candidate, metric)."""
    parts = [_metrics_rows(spark, p).withColumn("_prio", F.lit(prio)) for prio, p in ((0, specific), (1, combined)) if p]
    if not parts:
        raise ValueError("no metrics source")
    allm = parts[0]
    for p in parts[1:]:
        allm = allm.unionByName(p)
    return allm.groupBy("candidate", "metric").agg(F.min_by("value", "_prio").alias("value"))


def schema_findings_per_file(spark: SparkSession, path: str, numeric: list[str] = NUMERIC_COLUMNS,
                             strings: list[str] = STRING_COLUMNS, aliases: dict = COLUMN_ALIASES) -> DataFrame:
    """Findings for every Parquet file under ``path``, before aliasing: types
    from the footers (merged in parallel, a group per layout), presence from
    one aggregation over the rows.  A column counts as present in a file that
    has a value of it under any of its alias names."""
    expected = {c: "numeric" for c in numeric} | {c: "string" for c in strings}
    out = None
    for files, schema in file_layouts(spark, path):
        types = {f.name: f.dataType for f in schema.fields}
        df = spark.read.schema(schema).parquet(*files)
        cols, kind = [F.col("_metadata.file_path").alias("source_file")], {}
        for c in expected:
            hits = [v for v in aliases.get(c, [c]) if v in types]
            kind[c] = {v: _kind(types[v]) for v in hits}
            # which variant a row has says what type the file has
            cols.append(F.coalesce(*[F.when(F.col(f"`{v}`").isNotNull(), F.lit(_kind(types[v]))) for v in hits], F.lit(None).cast("string")).alias(c))
        per = df.select(*cols).groupBy("source_file").agg(*[F.max(c).alias(c) for c in expected])
        items = [F.struct(F.lit(c).alias("column"), F.lit(e).alias("expected"), F.col(c).alias("actual")) for c, e in expected.items()]
        part = per.select(F.regexp_extract("source_file", r"([^/]+)$", 1).alias("source"), F.inline(F.array(*items)))
        ok = (F.col("actual") == F.col("expected")) | ((F.col("expected") == "string") & (F.col("actual") == "timestamp"))
        part = part.withColumns({"present": F.col("actual").isNotNull(), "type_ok": F.coalesce(ok, F.lit(False))}) \
                   .withColumn("status", F.when(F.col("type_ok"), "ok").otherwise("warning"))
        out = part if out is None else out.unionByName(part)
    return out
