"""Checks of raw JSON records, before any type is forced on them: keys, kinds of values, versions, float precision.

A record is parsed once into a variant; what each field really holds decides, so a number in quotes is no number and an
absent key is not a null. A line that is no JSON, or in which a key is repeated, is invalid JSON; one that holds something
else than an object is no record.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from eventloom.schemas import DEFAULTED, SCHEMA_VERSION, SENSOR_REQUIRED, SENSOR_TYPES, STREAM_VERSIONS, TYPE_REQUIRED

from .validation import Check, all_failures, first_failure, physics_ranges, sensor_ranges

#: The largest number that still rounds to a finite 32-bit float.
FLOAT32_LIMIT = 3.4028235677973366e38
KEYS, VALUES = "__keys", "__values"


@dataclass(frozen=True)
class Policy:
    """What a check forgives.

    floats: 'rounded' (any number that a 32-bit float can round), 'exact' (one that it holds as it is), 'near' (one that
    it holds to 1e-3). unknown: other keys are left aside. absent: an absent nullable key counts as null.
    defaults: an absent key with a default is filled in. drift: another
    version is stamped over, with a warning, instead of rejected; None: the version is no matter of this check.
    """

    floats: str = "rounded"
    unknown: bool = False
    absent: bool = False
    defaults: bool = False
    drift: bool | None = False
    ignored: tuple[str, ...] = ()


#: The check before records are stored: a null version is stamped, another one is drift, and nothing may differ afterwards.
ENFORCE = Policy()
#: The report on files: fields of the schema only, and floats may lose precision.
LENIENT = Policy(unknown=True, absent=True, defaults=True, drift=None)
#: One record by itself: comments aside, every value comes back as it was.
STRICT = Policy(floats="exact", drift=None, ignored=("_comment",))
#: The producer's: versions are stamped, floats may move by less than 1e-3; keys beyond the schema never get on the wire.
PRODUCER = Policy(floats="near", unknown=True, absent=True, drift=True)


def parsed(df: DataFrame, raw: str) -> DataFrame:
    """Adds the keys and the values (by key) of a raw record; both are null where the line holds no object."""
    whole = df.withColumn("__v", F.try_parse_json(raw))
    object_ = F.schema_of_variant("__v").startswith("OBJECT")
    return whole.withColumn(VALUES, F.when(object_, F.expr("CAST(__v AS MAP<STRING, VARIANT>)"))).withColumn(KEYS, F.map_keys(VALUES))


def is_json() -> Column:
    return F.col("__v").isNotNull()


def value(name: str) -> Column:
    return F.col(VALUES)[name]


def kind(name: str) -> Column:
    """BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID and so on; null if the key is absent."""
    return F.schema_of_variant(value(name))


def number(name: str) -> Column:
    return F.try_variant_get(value(name), "$", "double")


def text(name: str) -> Column:
    """The value as text: that of a string, else its JSON; null for null and absent ones."""
    return F.try_variant_get(value(name), "$", "string")


def _fits(name: str, of: DataType) -> Column:
    """Whether a value that is there, and not null, is one of this type."""
    k = kind(name)
    if isinstance(of, StringType):
        return k == "STRING"
    if isinstance(of, IntegerType):
        return (k == "BIGINT") & number(name).between(-(2**31), 2**31 - 1)
    if isinstance(of, LongType):
        return k == "BIGINT"
    if isinstance(of, (FloatType, DoubleType)):
        return k.isin("BIGINT", "DOUBLE", "FLOAT") | k.startswith("DECIMAL")
    return k == of.simpleString().upper()


def _float_check(name: str, floats: str) -> Column:
    """Whether a number fails the policy for 32-bit floats."""
    d = number(name)
    too_large = F.abs(d) >= FLOAT32_LIMIT
    back = F.when(~too_large, d).cast("float").cast("double")
    if floats == "rounded":
        return too_large
    return too_large | ((back != d) if floats == "exact" else ~(F.abs(back - d) < 1e-3))


def record_checks(schema: StructType, domains: dict[str, tuple[str, ...]], policy: Policy, stream: str | None = None, version: str = "schema_version") -> list[Check]:
    """Checks in their order: JSON, version, keys, then each field's null, type, domain and precision."""
    if stream is not None and stream not in STREAM_VERSIONS:
        raise ValueError(f"unknown stream: {stream}")
    names = [f.name for f in schema]
    known = F.array(*[F.lit(n) for n in (*names, *policy.ignored)])
    stamped = policy.drift is not None
    checks: list[Check] = [(~is_json(), "invalid JSON"), (F.col(KEYS).isNull(), "not an object")]
    if policy.drift is False:
        expected = STREAM_VERSIONS[stream] if stream else SCHEMA_VERSION
        checks.append((F.coalesce(kind(version) != "VOID", F.lit(False)) & ~((kind(version) == "STRING") & (text(version) == expected)), "version drift"))
    if not policy.unknown:
        extra = F.array_sort(F.array_except(KEYS, known))
        checks.append((F.size(extra) > 0, F.concat(F.lit("unknown key: "), F.get(extra, 0))))
    for f in schema:
        if stamped and f.name == version:
            continue
        absent, null = value(f.name).isNull(), kind(f.name) == "VOID"
        if not policy.absent:
            checks.append((absent, f"{f.name} is absent"))
        if not f.nullable:
            checks.append((null if policy.defaults and f.name in DEFAULTED else absent | null, f"{f.name} is null"))
        checks.append((~null & ~_fits(f.name, f.dataType), f"{f.name} has the wrong type"))
        if f.name in domains:
            checks.append((~null & ~text(f.name).isin(*domains[f.name]), f"{f.name} outside its domain"))
        if isinstance(f.dataType, FloatType):
            checks.append((_float_check(f.name, policy.floats), f"{f.name} does not survive as a 32-bit float"))
    return checks


def check_records(df: DataFrame, raw: str, schema: StructType, policy: Policy = ENFORCE, domains: dict[str, tuple[str, ...]] | None = None, stream: str | None = None) -> DataFrame:
    """df with reason (null: the record passes) and stamped (a version was put in place of another or of none).

    raw is the column of JSON text; a null line is invalid JSON. Nothing is shuffled.
    """
    reason = first_failure(record_checks(schema, domains or {}, policy, stream))
    current = F.coalesce((kind("schema_version") == "STRING") & (text("schema_version") == SCHEMA_VERSION), F.lit(False))
    stamp = F.lit(False) if policy.drift is None else ~current
    found = parsed(df, raw).withColumn("reason", reason).withColumn("stamped", F.col("reason").isNull() & stamp)
    return found.select(*df.columns, "reason", "stamped")


def typed(df: DataFrame, raw: str, schema: StructType, doubles: bool = False) -> DataFrame:
    """The record as typed columns; what is absent, of another type or too large for it is null. Keeps df's other columns.

    With doubles, floats are as the line has them, before anything is rounded to 32 bits.
    """
    if doubles:
        schema = StructType([StructField(f.name, DoubleType() if isinstance(f.dataType, FloatType) else f.dataType, f.nullable) for f in schema])
    held = lambda f: _fits(f.name, f.dataType) & ~_float_check(f.name, "rounded") if isinstance(f.dataType, FloatType) else _fits(f.name, f.dataType)
    cols = [F.when(held(f), F.try_variant_get(value(f.name), "$", f.dataType.simpleString())).alias(f.name) for f in schema]
    taken = {f.name for f in schema}
    return parsed(df, raw).select(*[c for c in df.columns if c not in taken], *cols, KEYS, VALUES, "__v")


def required(schema: StructType, sensor: bool) -> list[tuple[str, Column]]:
    """Fields that a record must have, each with the condition under which it must."""
    if not sensor:
        return [(f.name, F.lit(True)) for f in schema]
    by_type = [(n, text("sensor_type") == t) for t, names in TYPE_REQUIRED.items() for n in names]
    return [(n, F.lit(True)) for n in SENSOR_REQUIRED] + by_type


def _listed(fields: list[tuple[str, Column]], bad) -> Column:
    return F.array_compact(F.array(*[F.when(when & bad(n), F.lit(n)) for n, when in fields]))


def findings(df: DataFrame, raw: str, schema: StructType, sensor: bool = True) -> DataFrame:
    """What a report on data quality says of each line: invalid_json, schema_reason, missing, nulls, ranges, sensor_type.

    missing: required keys that are absent; nulls: required keys that are null or absent; ranges: rules that are broken,
    as 'field: rule'. Lines that are no object have an invalid_json or a schema_reason and nothing else.
    """
    fields = required(schema, sensor)
    domains = {"sensor_type": SENSOR_TYPES} if sensor else {}
    own = df.toDF(*[f"__own_{n}" for n in df.columns])  # df's columns may be called like the record's
    wide = typed(own, f"__own_{raw}", schema, doubles=True).withColumn("schema_reason", F.when(is_json(), first_failure(record_checks(schema, domains, LENIENT))))
    none = F.array().cast("array<string>")
    object_ = F.col(KEYS).isNotNull()
    return wide.withColumns({
        "invalid_json": ~is_json(),
        "missing": F.when(object_, _listed(fields, lambda n: value(n).isNull())).otherwise(none),
        "nulls": F.when(object_, _listed(fields, lambda n: value(n).isNull() | (kind(n) == "VOID"))).otherwise(none),
        "ranges": F.when(object_, sensor_ranges() if sensor else physics_ranges()).otherwise(none),
        "kind": F.when(object_, F.coalesce(text("sensor_type"), F.lit("UNKNOWN"))),
    }).select(*[F.col(f"__own_{n}").alias(n) for n in df.columns], "kind", "invalid_json", "schema_reason", "missing", "nulls", "ranges")


def quality_report(found: DataFrame) -> DataFrame:
    """One row from findings: totals of lines, invalid JSON, schema failures, records with missing or null fields, broken range rules."""
    n = lambda bad: F.count_if(bad)
    return found.agg(
        F.count(F.lit(1)).alias("total_records"), n(F.col("invalid_json")).alias("invalid_json"), n(F.col("schema_reason").isNotNull()).alias("schema_failures"), n(F.size("missing") > 0).alias("missing_required"),
        n(F.size("nulls") > 0).alias("required_nulls"), F.coalesce(F.sum(F.size("ranges")), F.lit(0)).alias("range_violations"),
    )


def field_counts(found: DataFrame) -> DataFrame:
    """check, field, n: how often each field is missing, null or out of range, and records of each sensor type."""
    field = F.transform("ranges", lambda r: F.element_at(F.split(r, ": "), 1))
    tagged = lambda check, names: F.transform(names, lambda x: F.struct(F.lit(check).alias("check"), x.alias("field")))
    kinds = F.array_compact(F.array("kind"))
    every = F.concat(tagged("missing", F.col("missing")), tagged("null", F.col("nulls")), tagged("range", field), tagged("sensor_type", kinds))
    return found.select(F.explode(every).alias("f")).groupBy("f.check", "f.field").agg(F.count(F.lit(1)).alias("n"))


def examples(found: DataFrame, order: str, most: int = 20) -> DataFrame:
    """The first findings in the order of lines: line, check, message; of one line in the order of checks."""
    one = lambda check, said: F.when(said != "", F.struct(F.lit(check).alias("check"), said.alias("message")))
    joined = lambda c: F.array_join(c, ", ")
    checks = F.array_compact(F.array(
        one("JSON", F.when(F.col("invalid_json"), F.lit("invalid JSON")).otherwise("")), one("Schema", F.coalesce("schema_reason", F.lit(""))), one("Completeness", joined("missing")), one("Null", joined("nulls")),
    ))
    ranges = F.transform("ranges", lambda r: F.struct(F.lit("Range").alias("check"), r.alias("message")))
    listed = found.select(F.col(order).alias("line"), F.posexplode(F.concat(checks, ranges)).alias("place", "said"))
    return listed.orderBy("line", "place").limit(most).select("line", "said.check", "said.message")


def all_reasons(schema: StructType, domains: dict[str, tuple[str, ...]], policy: Policy) -> Column:
    """Every check that a parsed record fails, not only the first."""
    return all_failures(record_checks(schema, domains, policy))
