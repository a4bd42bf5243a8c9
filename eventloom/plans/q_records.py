"""Queries: raw records, Avro on the wire and at rest, and whole jobs over them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, LongType, StringType

from eventloom.operators import jobs
from eventloom.operators import records as k
from eventloom.operators import validation as q
from eventloom.schemas import DEFAULTED, PHYSICS_EVENT, SENSOR_EVENT, SENSOR_REQUIRED, SENSOR_TYPES, TYPE_REQUIRED
from eventloom.sources import avro
from eventloom.sources.files import events
from eventloom.storage import fresh_path

from .views import E

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


# Raw lines are made by the same SQL in both engines, then broken by the event's number.
def broken(base: str, by: int, changes: list[tuple[str, str]]) -> str:
    cases = " ".join(f"WHEN {n} THEN {new if not old else f'replace({base}, {old}, {new})'}" for n, (old, new) in enumerate(changes, 1))
    return f"CASE event_id % {by} {cases} ELSE {base} END"


PHYSICS = """('{"event_id":"' || lpad(event_id || '', 32, '0') || '","run_number":7,"timestamp_ms":' || ms || ',"track_count":3,"net_momentum_x":0.5,"net_momentum_y":-0.125,"net_momentum_z":1.25,"max_energy_gev":4.875,"total_energy_gev":89.5,"schema_version":"1.0"}')"""
PHYSICS_RAW = broken(PHYSICS, 23, [
    ("'\"run_number\":7'", "'\"run_number\":\"7\"'"), ("'\"run_number\":7'", "'\"run_number\":7.5'"), ("'\"track_count\":3,'", "''"), ("'\"track_count\":3,'", "'\"track_count\":3,\"extra\":1,'"), ("'\"1.0\"'", "'\"9.9\"'"), ("'\"1.0\"'", "null_text"),
    ("'\"run_number\":7'", "'\"run_number\":null'"), ("'4.875'", "'1e39'"), ("'4.875'", "'0.1'"), ("'\"track_count\":3'", "'\"track_count\":true'"), ("", "'{broken'"), ("'\"track_count\":3,'", "'\"track_count\":3,\"_comment\":\"x\",'"),
    ("", "'[1,2]'"), ("'\"net_momentum_x\":0.5,'", "''"), ("'\"run_number\":7'", "'\"run_number\":3000000000'"), ("',\"schema_version\":\"1.0\"'", "''"), ("'\"1.0\"'", "'1.0'"), ("'89.5'", "'16777217'"), ("'89.5'", "'0.30000001'"), ("'\"track_count\":3'", "'\"track_count\":-4'"),
]).replace("null_text", "'null'")

SENSOR = """(CASE event_id % 3
    WHEN 0 THEN '{"event_id":"' || lpad(event_id || '', 32, '0') || '","sensor_id":"R-01","sensor_type":"RADAR","timestamp_ms":' || ms || ',"target_id":"T-1","range_m":' || (value * 10 - 50) || ',"bearing_deg":' || (value * 4) || ',"elevation_deg":' || (value - 100) || ',"velocity_ms":-25.5,"signal_strength_db":-65.5,"schema_version":"1.0"}'
    WHEN 1 THEN '{"event_id":"' || lpad(event_id || '', 32, '0') || '","sensor_id":"L-01","sensor_type":"LIDAR","timestamp_ms":' || ms || ',"scan_id":"S-1","point_count":' || (user_id - 3) || ',"centroid_x_m":12.5,"centroid_y_m":-7.25,"centroid_z_m":1.5,"max_range_m":' || (value - 2) || ',"avg_intensity":' || value || ',"min_intensity":' || (20 - value) || ',"schema_version":"1.0"}'
    ELSE '{"event_id":"' || lpad(event_id || '', 32, '0') || '","sensor_id":"T-01","sensor_type":"TELEMETRY","timestamp_ms":' || ms || ',"device_id":"UAV-07","parameter_name":"' || (CASE WHEN user_id % 2 = 0 THEN 'battery_pct' ELSE 'cpu_temp_c' END) || '","value":' || (value * 3 - 10) || ',"unit":"C","sequence_number":' || (user_id - 5) || ',"schema_version":"1.0"}' END)"""
SENSOR_RAW = broken(SENSOR, 31, [
    ("'\"1.0\"'", "'\"9.9\"'"), ("'\"sensor_id\":'", "'\"other_id\":'"), ("'\"sensor_id\":\"R-01\"'", "'\"sensor_id\":null'"), ("'RADAR'", "'SONAR'"), ("'\"target_id\":\"T-1\",'", "''"), ("'\"scan_id\":\"S-1\"'", "'\"scan_id\":null'"), ("'\"unit\":\"C\",'", "''"),
    ("", "'not json'"), ("'\"timestamp_ms\":'", "'\"timestamp_ms\":-'"), ("'\"1.0\"'", "'null'"), ("'-25.5'", "'\"fast\"'"), ("'12.5'", "'1e40'"),
])


def physics_lines(spark, sf):
    return events(spark, sf).select("event_id", F.expr(PHYSICS_RAW).alias("raw"))


def sensor_lines(spark, sf):
    return events(spark, sf).select("event_id", F.expr(SENSOR_RAW).alias("raw"))


# The same checks in DuckDB's JSON functions.
def lines_sql(raw: str) -> str:
    return f"{E}, raw AS (SELECT event_id, {raw} AS raw FROM e), j AS (SELECT event_id, raw, json_valid(raw) AS ok, CASE WHEN json_valid(raw) AND json_type(raw) = 'OBJECT' THEN raw ELSE '{{}}' END AS r, CASE WHEN json_valid(raw) THEN json_type(raw) = 'OBJECT' END AS is_object FROM raw)"


def type_sql(name: str) -> str:
    return f"json_type(r, '$.{name}')"


def text_sql(name: str) -> str:
    return f"json_extract_string(r, '$.{name}')"


def number_sql(name: str) -> str:
    return f"CASE WHEN {type_sql(name)} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST({text_sql(name)} AS DOUBLE) END"


def fits_sql(f) -> str:
    t = type_sql(f.name)
    if isinstance(f.dataType, StringType):
        return f"{t} = 'VARCHAR'"
    if isinstance(f.dataType, IntegerType):
        return f"({t} IN ('UBIGINT', 'BIGINT') AND {number_sql(f.name)} BETWEEN -2147483648 AND 2147483647)"
    if isinstance(f.dataType, LongType):
        return f"{t} IN ('UBIGINT', 'BIGINT')"
    return f"{t} IN ('UBIGINT', 'BIGINT', 'DOUBLE')"


def reason_sql(schema, policy: k.Policy, domains: dict) -> str:
    out = ["WHEN NOT ok THEN 'invalid JSON'", "WHEN NOT is_object THEN 'not an object'"]
    v = "schema_version"
    if policy.drift is False:
        out.append(f"WHEN {type_sql(v)} <> 'NULL' AND NOT ({type_sql(v)} = 'VARCHAR' AND {text_sql(v)} = '1.0') THEN 'version drift'")
    if not policy.unknown:
        known = ", ".join(f"'{n}'" for n in [*(f.name for f in schema), *policy.ignored])
        extra = f"list_sort(list_filter(json_keys(r), lambda x: x NOT IN ({known})))"
        out.append(f"WHEN len({extra}) > 0 THEN 'unknown key: ' || {extra}[1]")
    for f in schema:
        if policy.drift is not None and f.name == v:
            continue
        t = type_sql(f.name)
        if not policy.absent:
            out.append(f"WHEN {t} IS NULL THEN '{f.name} is absent'")
        if not f.nullable:
            absent = "false" if policy.defaults and f.name in DEFAULTED else f"{t} IS NULL"
            out.append(f"WHEN {absent} OR {t} = 'NULL' THEN '{f.name} is null'")
        out.append(f"WHEN {t} <> 'NULL' AND NOT {fits_sql(f)} THEN '{f.name} has the wrong type'")
        if f.name in domains:
            out.append(f"WHEN {text_sql(f.name)} NOT IN ({', '.join(repr(d) for d in domains[f.name])}) THEN '{f.name} outside its domain'")
        if isinstance(f.dataType, FloatType):
            d = f"({number_sql(f.name)})"
            large = f"abs({d}) >= {k.FLOAT32_LIMIT}"
            back = f"CAST(CAST({d} AS FLOAT) AS DOUBLE)"
            lost = {"rounded": "false", "exact": f"{back} <> {d}", "near": f"NOT abs({back} - {d}) < 0.001"}[policy.floats]
            out.append(f"WHEN CASE WHEN {large} THEN true ELSE {lost} END THEN '{f.name} does not survive as a 32-bit float'")
    return "CASE " + " ".join(out) + " END"


STAMPED = "NOT coalesce(json_type(r, '$.schema_version') = 'VARCHAR' AND json_extract_string(r, '$.schema_version') = '1.0', false)"
SENSOR_DOMAIN = {"sensor_type": SENSOR_TYPES}


def checked(name: str, policy: k.Policy, sensor: bool):
    """Registers one check of raw records, over lines of one family."""
    schema, domains, raw = (SENSOR_EVENT, SENSOR_DOMAIN, SENSOR_RAW) if sensor else (PHYSICS_EVENT, {}, PHYSICS_RAW)
    stamped = "false" if policy.drift is None else STAMPED
    sql = f"WITH {lines_sql(raw)}, x AS (SELECT event_id, r, {reason_sql(schema, policy, domains)} AS reason FROM j) SELECT event_id, reason, reason IS NULL AND {stamped} AS stamped FROM x"

    @query(name, sql)
    def _(spark, sf):
        lines = sensor_lines(spark, sf) if sensor else physics_lines(spark, sf)
        return k.check_records(lines, "raw", schema, policy, domains).select("event_id", "reason", "stamped")


# Records of sensors list no fields of other kinds of sensors here, so absent ones count as null.
checked("record_enforced", k.ENFORCE, False)
checked("record_lenient", k.LENIENT, False)
checked("record_strict", k.STRICT, False)
checked("record_producer", k.PRODUCER, False)
checked("record_enforced_sensor", k.Policy(absent=True), True)
checked("record_lenient_sensor", k.LENIENT, True)


# The report on data quality.
def list_sql(fields: list[tuple[str, str]], bad: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {when} AND {bad.format(t=type_sql(n))} THEN '{n}' END" for n, when in fields) + "], lambda x: x IS NOT NULL)"


def range_sql() -> str:
    n, t = number_sql, "json_extract_string(r, '$.sensor_type')"
    v = lambda name: f"({n(name)})"
    low = lambda kind, name: f"CASE WHEN {t} = '{kind}' AND {v(name)} < 0 THEN '{name}: must be greater than or equal to 0' END"
    between = lambda name, a, b: f"CASE WHEN {t} = 'RADAR' AND {v(name)} NOT BETWEEN {a} AND {b} THEN '{name}: must be between {a} and {b}' END"
    rules = [
        f"CASE WHEN {t} IS NULL OR {t} NOT IN ('RADAR', 'LIDAR', 'TELEMETRY') THEN 'sensor_type: unsupported sensor type' END", f"CASE WHEN {v('timestamp_ms')} <= 0 THEN 'timestamp_ms: must be greater than 0' END",
        "CASE WHEN json_extract_string(r, '$.schema_version') IS DISTINCT FROM '1.0' THEN 'schema_version: must equal 1.0' END", low("RADAR", "range_m"), between("bearing_deg", 0, 360), between("elevation_deg", -90, 90),
        *[low("LIDAR", x) for x in ("point_count", "max_range_m", "avg_intensity", "min_intensity")], f"CASE WHEN {t} = 'LIDAR' AND {v('min_intensity')} > {v('avg_intensity')} THEN 'min_intensity: must not exceed avg_intensity' END",
        low("TELEMETRY", "sequence_number"), f"CASE WHEN {t} = 'TELEMETRY' AND json_extract_string(r, '$.parameter_name') = 'battery_pct' AND {v('value')} NOT BETWEEN 0 AND 100 THEN 'value: battery_pct must be between 0 and 100' END",
    ]
    return "list_filter([" + ", ".join(rules) + "], lambda x: x IS NOT NULL)"


_FIELDS = [(n, "true") for n in SENSOR_REQUIRED] + [(n, f"json_extract_string(r, '$.sensor_type') = '{t}'") for t, names in TYPE_REQUIRED.items() for n in names]
FINDINGS = f"""{lines_sql(SENSOR_RAW)}, f AS (SELECT event_id, NOT ok AS invalid_json, CASE WHEN ok THEN {reason_sql(SENSOR_EVENT, k.LENIENT, SENSOR_DOMAIN)} END AS schema_reason,
    CASE WHEN is_object THEN coalesce(json_extract_string(r, '$.sensor_type'), 'UNKNOWN') END AS kind, CASE WHEN is_object THEN {list_sql(_FIELDS, '{t} IS NULL')} ELSE [] END AS missing,
    CASE WHEN is_object THEN {list_sql(_FIELDS, "({t} IS NULL OR {t} = 'NULL')")} ELSE [] END AS nulls, CASE WHEN is_object THEN {range_sql()} ELSE [] END AS ranges FROM j)"""


def found(spark, sf):
    return k.findings(sensor_lines(spark, sf), "raw", SENSOR_EVENT)


@query("quality_findings", f"WITH {FINDINGS} SELECT event_id, invalid_json, schema_reason, array_to_string(missing, ',') AS missing, array_to_string(nulls, ',') AS nulls, array_to_string(ranges, '|') AS ranges FROM f")
def _(spark, sf):
    return found(spark, sf).select("event_id", "invalid_json", "schema_reason", F.array_join("missing", ",").alias("missing"), F.array_join("nulls", ",").alias("nulls"), F.array_join("ranges", "|").alias("ranges"))


@query("quality_report", f"""WITH {FINDINGS} SELECT count(*) AS total_records, CAST(count_if(invalid_json) AS BIGINT) AS invalid_json, count(schema_reason) AS schema_failures, CAST(count_if(len(missing) > 0) AS BIGINT) AS missing_required,
    CAST(count_if(len(nulls) > 0) AS BIGINT) AS required_nulls, CAST(sum(len(ranges)) AS BIGINT) AS range_violations FROM f""")
def _(spark, sf):
    return k.quality_report(found(spark, sf))


@query("quality_fields", f"""WITH {FINDINGS}, t AS (SELECT 'missing' AS "check", unnest(missing) AS field FROM f UNION ALL SELECT 'null', unnest(nulls) FROM f UNION ALL SELECT 'range', split_part(unnest(ranges), ': ', 1) FROM f
    UNION ALL SELECT 'sensor_type', kind FROM f WHERE kind IS NOT NULL) SELECT "check", field, count(*) AS n FROM t GROUP BY 1, 2""")
def _(spark, sf):
    return k.field_counts(found(spark, sf))


@query("quality_examples", f"""WITH {FINDINGS}, t AS (SELECT event_id AS line, unnest(list_concat(list_filter([CASE WHEN invalid_json THEN {{'check': 'JSON', 'message': 'invalid JSON'}} END, CASE WHEN schema_reason IS NOT NULL THEN {{'check': 'Schema', 'message': schema_reason}} END,
    CASE WHEN len(missing) > 0 THEN {{'check': 'Completeness', 'message': array_to_string(missing, ', ')}} END, CASE WHEN len(nulls) > 0 THEN {{'check': 'Null', 'message': array_to_string(nulls, ', ')}} END], lambda x: x IS NOT NULL),
    list_transform(ranges, lambda r: {{'check': 'Range', 'message': r}}))) AS said, generate_subscripts(list_concat(list_filter([invalid_json, schema_reason IS NOT NULL, len(missing) > 0, len(nulls) > 0], lambda x: x), list_transform(ranges, lambda r: true)), 1) AS place FROM f)
    SELECT line, said['check'] AS "check", said['message'] AS message FROM t ORDER BY line, place LIMIT 20""")
def _(spark, sf):
    return k.examples(found(spark, sf), "event_id")


@query("class_balance", f"WITH {E} SELECT event_type, count(*) AS n, round(avg(CASE WHEN user_id % 5 = 0 THEN 1.0 ELSE 0.0 END), 9) AS share, abs(avg(CASE WHEN user_id % 5 = 0 THEN 1.0 ELSE 0.0 END) - 0.2) <= 0.003 AS balanced FROM e GROUP BY 1")
def _(spark, sf):
    rows = events(spark, sf).withColumn("label", (F.col("user_id") % 5 == 0).cast("int"))
    return q.class_balance(rows, "event_type", 0.2).withColumn("share", F.round("share", 9))


def staging_sql() -> str:
    """The staging checks over typed values, where one of another type counts as null."""
    small = lambda n: f" AND NOT coalesce(abs({number_sql(n)}) >= {k.FLOAT32_LIMIT}, false)"
    held = {f.name: f"(coalesce({fits_sql(f)}, false){small(f.name) if isinstance(f.dataType, FloatType) else ''})" for f in SENSOR_EVENT}
    kind = f"upper(CASE WHEN {held['sensor_type']} THEN {text_sql('sensor_type')} END)"
    out = [f"WHEN NOT ({held['schema_version']} AND {text_sql('schema_version')} = '1.0') THEN 'schema_version must be ' || chr(39) || '1.0' || chr(39)"]
    out += [f"WHEN NOT {held[n]} THEN 'required field missing or null: {n}'" for n in SENSOR_REQUIRED]
    out.append(f"WHEN {kind} NOT IN ('RADAR', 'LIDAR', 'TELEMETRY') THEN 'sensor_type not supported: ' || {kind}")
    out += [f"WHEN {kind} = '{t}' AND NOT {held[n]} THEN 'required {t} field missing or null: {n}'" for t, names in TYPE_REQUIRED.items() for n in names]
    out.append(f"WHEN CAST({text_sql('timestamp_ms')} AS BIGINT) <= 0 THEN 'timestamp_ms must be a positive integer'")
    return "CASE " + " ".join(out) + " END"


@query("staging_validation_kinds", f"WITH {lines_sql(SENSOR_RAW)} SELECT event_id AS line, {staging_sql()} AS reason FROM j WHERE is_object")
def _(spark, sf):
    rows = k.typed(sensor_lines(spark, sf).withColumnRenamed("event_id", "line"), "raw", SENSOR_EVENT).where(F.col(k.KEYS).isNotNull())
    return rows.select("line", q.staging_sensor().alias("reason"))


# Avro.
WIRE = avro.avro_schema(SENSOR_EVENT, "sensor_event", {"sensor_type": SENSOR_TYPES})


def radar_rows(spark, sf):
    i = F.col("event_id")
    rows = events(spark, sf).select(
        F.concat(F.lit("e-"), i.cast("string")).alias("event_id"), F.lit("R-01").alias("sensor_id"), F.lit("RADAR").alias("sensor_type"), F.col("ms").alias("timestamp_ms"), F.when(i % 3 != 0, "Ziel-ä").alias("target_id"),
        F.col("value").cast("float").alias("range_m"), F.when(i % 5 != 0, (-F.col("value")).cast("float")).alias("bearing_deg"), F.when(i % 7 == 0, i).alias("sequence_number"), F.when(i % 11 == 0, (i % 100 - 50).cast("int")).alias("point_count"), F.lit("1.0").alias("schema_version"),
    )
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in SENSOR_EVENT if f.name not in rows.columns}).select(*SENSOR_EVENT.names)


WIRE_SQL = f"""WITH {E}, w AS (SELECT 'e-' || event_id AS event_id, ms AS timestamp_ms, CASE WHEN event_id % 3 <> 0 THEN 'Ziel-ä' END AS target_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS range_m, CASE WHEN event_id % 5 <> 0 THEN CAST(CAST(-value AS FLOAT) AS DOUBLE) END AS bearing_deg,
    CASE WHEN event_id % 7 = 0 THEN event_id END AS sequence_number, CASE WHEN event_id % 11 = 0 THEN CAST(event_id % 100 - 50 AS INTEGER) END AS point_count FROM e)"""


def shown(df):
    return df.select("event_id", "timestamp_ms", "target_id", F.col("range_m").cast("double").alias("range_m"), F.col("bearing_deg").cast("double").alias("bearing_deg"), "sequence_number", "point_count")


@query("avro_payload", f"{WIRE_SQL} SELECT * FROM w")
def _(spark, sf):
    return shown(avro.decode_payload(avro.encode_payload(radar_rows(spark, sf), WIRE, ("timestamp_ms",)).drop("timestamp_ms"), "value", WIRE))


@query("avro_container", f"{WIRE_SQL} SELECT * FROM w")
def _(spark, sf):
    path = fresh_path(spark, "avro")
    avro.write_avro(radar_rows(spark, sf), path, WIRE)
    return shown(avro.read_avro(spark, path, WIRE))


@query("avro_summary", f"WITH {E} SELECT CAST(count_if(event_id % 17 <> 0 AND event_id % 29 <> 0) AS BIGINT) AS record_count, CAST(count_if(event_id % 29 = 0) AS BIGINT) AS rejected_version_drift, CAST(count_if(event_id % 17 = 0 AND event_id % 29 <> 0) AS BIGINT) AS rejected_round_trip_failed FROM e")
def _(spark, sf):
    i = F.split("event_id", "-")[1].cast("bigint")
    rows = radar_rows(spark, sf).withColumns({"sensor_type": F.when(i % 17 == 0, "SONAR").otherwise(F.col("sensor_type")), "schema_version": F.when(i % 29 == 0, "9.9").when(i % 2 == 0, "1.0")})
    summary = avro.write_enforced(q.enforce(rows, "sensor_event", SENSOR_EVENT, SENSOR_DOMAIN), fresh_path(spark, "avro"), WIRE)
    return summary.agg(*[F.sum(c).alias(c) for c in ("record_count", "rejected_version_drift", "rejected_round_trip_failed")])


@query("avro_families", f"WITH {E} SELECT CASE event_id % 3 WHEN 0 THEN 'RADAR' WHEN 1 THEN 'LIDAR' ELSE 'TELEMETRY' END AS sensor_type, count(*) AS n, max(ms) AS newest FROM e GROUP BY 1")
def _(spark, sf):
    # Rows as Parquet, from there to Avro, and from there to a dataset apart by kinds of sensors.
    i = F.split("event_id", "-")[1].cast("bigint")
    one, two, three = (fresh_path(spark, n) for n in ("rows", "avro", "families"))
    radar_rows(spark, sf).withColumn("sensor_type", F.when(i % 3 == 0, "RADAR").when(i % 3 == 1, "LIDAR").otherwise("TELEMETRY")).drop("unit").write.parquet(one)
    avro.parquet_to_avro(spark, one, two, WIRE)
    avro.avro_to_parquet(spark, two, three, WIRE, ["sensor_type"])
    return spark.read.parquet(three).groupBy("sensor_type").agg(F.count(F.lit(1)).alias("n"), F.max("timestamp_ms").alias("newest"))


# Whole jobs.
def held_sql(schema) -> str:
    """Whether every field is there, of its type, and no float beyond 32 bits."""
    large = lambda f: f" AND NOT coalesce(abs({number_sql(f.name)}) >= {k.FLOAT32_LIMIT}, false)" if isinstance(f.dataType, FloatType) else ""
    return " AND ".join(f"coalesce({fits_sql(f)}, false){large(f)}" for f in schema)


@query("ingest_counts", f"""WITH {lines_sql(PHYSICS_RAW)}, m AS (SELECT event_id, ok, coalesce(is_object, false) AND {held_sql(PHYSICS_EVENT)} AND json_extract_string(r, '$.schema_version') = '1.0' AS fit FROM j WHERE event_id % 4 <> 3)
    SELECT CAST(count_if(NOT ok) AS BIGINT) AS malformed, CAST(count_if(ok AND NOT fit) AS BIGINT) AS rejected, CAST(count_if(fit) AS BIGINT) AS valid, CAST(count_if(fit AND event_id % 2 = 1) AS BIGINT) AS inserted FROM m""")
def _(spark, sf):
    path, target = fresh_path(spark, "lines"), fresh_path(spark, "staging")
    lines = physics_lines(spark, sf)
    lines.where("event_id % 2 = 0").select(F.col("raw").alias("value")).write.text(path + "/a")
    lines.where("event_id % 4 <> 3").select(F.col("raw").alias("value")).write.text(path + "/b")
    jobs.ingest_ndjson(spark, path + "/a", target, PHYSICS_EVENT)
    # What the first run has inserted is not inserted again.
    return spark.createDataFrame([tuple(jobs.ingest_ndjson(spark, path + "/b", target, PHYSICS_EVENT).values())], "malformed long, rejected long, valid long, inserted long")
