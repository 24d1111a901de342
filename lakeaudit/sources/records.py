"""Strict decoding of JSON records: every field is checked by name and kind before any is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


class DecodingError(ValueError):
    """Stored records do not have the declared fields."""


def _kind_fits(kind: Column, value: Column, declared: T.DataType) -> Column:
    """Whether a JSON value of this kind (as Spark names it for variants) can be a value of the declared type."""
    whole = (kind == "BIGINT") & value.try_cast(declared.simpleString()).isNotNull()
    if isinstance(declared, T.BooleanType):
        return kind == "BOOLEAN"
    if isinstance(declared, T.StringType):
        return kind == "STRING"
    if isinstance(declared, T.DateType):
        return (kind == "STRING") & value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull()
    if isinstance(declared, T.IntegralType):
        return whole
    if isinstance(declared, (T.DoubleType, T.FloatType)):
        return (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    raise ValueError(f"records have no fields of type {declared.simpleString()}")


def record_problems(records: DataFrame, schema: str | T.StructType, column: str = "value") -> DataFrame:
    """The records of a text column with an array ``problems`` of ``kind, field``; it is empty for records to trust.

    Kinds: ``malformed`` (no JSON object, or a name given twice), ``missing``, ``extra``, ``null`` (in a field declared
    NOT NULL) and ``retyped``. A field that may be null must be there all the same. One scan, no shuffle.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text, whole = F.col(column), F.try_parse_json(F.col(column))
    names = F.json_object_keys(column)
    broken = whole.isNull() | names.isNull() | ~F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))
    problem = lambda kind, field: F.struct(F.lit(kind).alias("kind"), field.alias("field"))
    found = []
    for field in schema.fields:
        path = f"$['{field.name}']"
        kind = F.schema_of_variant(F.variant_get(whole, path, "variant"))
        value = F.try_variant_get(whole, path, "string")
        fits = F.coalesce(_kind_fits(kind, value, field.dataType), F.lit(False))
        nothing = F.lit(None) if field.nullable else problem("null", F.lit(field.name))
        found.append(
            F.when(~F.array_contains(names, field.name), problem("missing", F.lit(field.name)))
            .when(kind == "VOID", nothing).when(~fits, problem("retyped", F.lit(field.name))))
    known = F.array(*[F.lit(n) for n in schema.names])
    extra = F.transform(F.array_except(names, known), lambda n: problem("extra", n))
    problems = F.when(text.isNull() | broken, F.array(problem("malformed", F.lit(None).cast("string")))).otherwise(
        F.concat(F.filter(F.array(*found), lambda p: p.isNotNull()), extra))
    return records.withColumn("problems", problems)


def read_records(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The JSON lines below ``path`` as rows of the schema; :class:`DecodingError` names what is wrong with some of them."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path).select("value")
    wrong = record_problems(lines, schema).select(F.explode("problems").alias("p"))
    counts = wrong.groupBy("p.kind", "p.field").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "field").limit(20).collect()
    if counts:
        raise DecodingError(f"{path}: " + "; ".join(f"{r.kind} {r.field or 'record'} ({r.n})" for r in counts))
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def schema_problems(stored: T.StructType, declared: str | T.StructType) -> list[str]:
    """What differs between the columns of a stored table and the declared ones, by name; nullability is not compared."""
    declared = T.StructType.fromDDL(declared) if isinstance(declared, str) else declared
    have, want = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (stored, declared))
    return [f"missing {n}" for n in want if n not in have] + [f"extra {n}" for n in have if n not in want] + [
        f"retyped {n}: {have[n]}, not {want[n]}" for n in want if n in have and have[n] != want[n]]
