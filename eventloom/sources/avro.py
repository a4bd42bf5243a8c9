"""Avro without a connector: payloads and container files, decoded and encoded in Arrow batches.

Schemas are the JSON of the Avro specification; names of types may be used again after they are defined. Containers are
read as binary files and written by Spark's own writer and committer, one file for each row, so that any store works and
a repeated task leaves no second copy.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, MapType, StringType, StructField, StructType

from eventloom.operators.sinks import in_order, write_parquet
from eventloom.operators.validation import Enforced
from eventloom.storage import fresh_path, path_exists

MAGIC = b"Obj\x01"
PRIMITIVES = {"boolean": BooleanType(), "int": IntegerType(), "long": LongType(), "float": FloatType(), "double": DoubleType(), "bytes": BinaryType(), "string": StringType()}
#: Records in a block, bytes of blocks in a container file.
BLOCK_RECORDS, FILE_BYTES = 1000, 64 << 20


class AvroError(ValueError):
    """Bytes or values that don't fit their schema."""


# Schemas.
def avro_schema(of: StructType, name: str, enums: dict[str, tuple[str, ...]] | None = None) -> dict:
    """The record schema of a struct: nullable fields are unions with null and default to it."""
    kinds = {type(v): k for k, v in PRIMITIVES.items()}

    def kind(f: StructField):
        base = {"type": "enum", "name": f"{f.name}_enum", "symbols": list(enums[f.name])} if enums and f.name in enums else kinds[type(f.dataType)]
        return {"name": f.name, "type": ["null", base], "default": None} if f.nullable else {"name": f.name, "type": base}

    return {"type": "record", "name": name, "fields": [kind(f) for f in of]}


def _resolve(schema, known: dict):
    """A schema with names of types replaced by what they stand for."""
    if isinstance(schema, str):
        return schema if schema in PRIMITIVES or schema == "null" else known[schema]
    if isinstance(schema, list):
        return [_resolve(s, known) for s in schema]
    kind = schema["type"]
    if kind in ("enum", "fixed"):
        known[schema["name"]] = schema
        return schema
    if kind == "record":
        made = {"type": "record", "name": schema["name"], "fields": []}
        known[schema["name"]] = made
        made["fields"] = [{**f, "type": _resolve(f["type"], known)} for f in schema["fields"]]
        return made
    if kind == "array":
        return {"type": "array", "items": _resolve(schema["items"], known)}
    if kind == "map":
        return {"type": "map", "values": _resolve(schema["values"], known)}
    return _resolve(kind, known)


def resolved(schema: str | dict) -> dict:
    return _resolve(json.loads(schema) if isinstance(schema, str) else schema, {})


def spark_type(schema) -> tuple[DataType, bool]:
    """The type of a resolved schema, and whether it may be null."""
    if isinstance(schema, list):
        rest = [s for s in schema if s != "null"]
        if len(rest) != 1:
            raise AvroError("a union of several types besides null has no column type")
        return spark_type(rest[0])[0], len(rest) < len(schema)
    if isinstance(schema, str):
        return PRIMITIVES[schema], False
    kind = schema["type"]
    if kind == "record":
        return StructType([StructField(f["name"], *spark_type(f["type"])) for f in schema["fields"]]), False
    if kind == "array":
        return ArrayType(*spark_type(schema["items"])), False
    if kind == "map":
        return MapType(StringType(), *spark_type(schema["values"])), False
    return (StringType() if kind == "enum" else BinaryType()), False


# Values. A reader takes (bytes, place) and gives (value, place); a writer appends to a bytearray.
def _read_long(raw: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        try:
            byte = raw[at]
        except IndexError:
            raise AvroError("the record ends too early") from None
        at += 1
        n |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (n >> 1) ^ -(n & 1), at
        if (shift := shift + 7) > 63:
            raise AvroError("a number has too many bytes")


def _write_long(n: int, out: bytearray) -> None:
    n = ((n << 1) ^ (n >> 63)) & 0xFFFFFFFFFFFFFFFF
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)


def _read_bytes(raw: bytes, at: int) -> tuple[bytes, int]:
    n, at = _read_long(raw, at)
    if n < 0 or at + n > len(raw):
        raise AvroError("the record ends too early")
    return raw[at : at + n], at + n


def _reader(schema) -> Callable:
    if isinstance(schema, list):
        branches = [_reader(s) for s in schema]

        def union(raw, at):
            k, at = _read_long(raw, at)
            if not 0 <= k < len(branches):
                raise AvroError("no such branch of a union")
            return branches[k](raw, at)

        return union
    kind = schema if isinstance(schema, str) else schema["type"]
    if kind == "null":
        return lambda raw, at: (None, at)
    if kind in ("int", "long"):
        return _read_long
    if kind in ("float", "double"):
        form = struct.Struct("<f" if kind == "float" else "<d")

        def real(raw, at):
            if at + form.size > len(raw):
                raise AvroError("the record ends too early")
            return form.unpack_from(raw, at)[0], at + form.size

        return real
    if kind == "bytes":
        return _read_bytes
    if kind == "string":

        def text(raw, at):
            found, at = _read_bytes(raw, at)
            try:
                return found.decode(), at
            except UnicodeDecodeError:
                raise AvroError("a string that is no UTF-8") from None

        return text
    if kind == "boolean":

        def truth(raw, at):
            if raw[at : at + 1] not in (b"\0", b"\1"):
                raise AvroError("no boolean")
            return raw[at] == 1, at + 1

        return truth
    if kind == "enum":
        symbols = schema["symbols"]

        def symbol(raw, at):
            k, at = _read_long(raw, at)
            if not 0 <= k < len(symbols):
                raise AvroError("no such symbol")
            return symbols[k], at

        return symbol
    if kind == "fixed":
        size = schema["size"]

        def fixed(raw, at):
            if at + size > len(raw):
                raise AvroError("the record ends too early")
            return raw[at : at + size], at + size

        return fixed
    if kind == "record":
        fields = [(f["name"], _reader(f["type"])) for f in schema["fields"]]

        def record(raw, at):
            made = {}
            for name, read in fields:
                made[name], at = read(raw, at)
            return made, at

        return record
    item = _reader(schema["items"] if kind == "array" else schema["values"])

    def blocks(raw, at):
        made = []
        while True:
            n, at = _read_long(raw, at)
            if not n:
                return (made if kind == "array" else dict(made)), at
            if n < 0:
                n, (_, at) = -n, _read_long(raw, at)
            for _ in range(n):
                key = None
                if kind == "map":
                    key, at = _read_bytes(raw, at)
                one, at = item(raw, at)
                made.append(one if kind == "array" else (key.decode(), one))

    return blocks


def _fits(schema, x) -> bool:
    """Whether a value is of a type, by the kind of Python object that it is."""
    kind = schema if isinstance(schema, str) else schema["type"]
    if kind == "null":
        return x is None
    if kind in ("int", "long"):
        bits = 31 if kind == "int" else 63
        return isinstance(x, int) and not isinstance(x, bool) and -(1 << bits) <= x < 1 << bits
    if kind in ("float", "double"):
        return isinstance(x, (int, float)) and not isinstance(x, bool)
    if kind == "enum":
        return x in schema["symbols"]
    return isinstance(x, {"string": str, "boolean": bool, "bytes": bytes, "fixed": bytes, "record": dict, "array": list, "map": (dict, list)}[kind])


def _writer(schema, where: str = "record") -> Callable:
    if isinstance(schema, list):
        branches = [(s, _writer(s, where)) for s in schema]

        def union(x, out):
            for k, (s, write) in enumerate(branches):
                if _fits(s, x):
                    _write_long(k, out)
                    return write(x, out)
            raise AvroError(f"{where}: {x!r} fits no branch")

        return union
    kind = schema if isinstance(schema, str) else schema["type"]

    def checked(write):
        def run(x, out):
            if not _fits(schema, x):
                raise AvroError(f"{where}: {x!r} is no {kind}")
            write(x, out)

        return run

    def sized(x, out):
        _write_long(len(x), out)
        out += x

    if kind == "null":
        return checked(lambda x, out: None)
    if kind in ("int", "long"):
        return checked(_write_long)
    if kind in ("float", "double"):
        form = struct.Struct("<f" if kind == "float" else "<d")

        def real(x, out):
            try:
                out += form.pack(x)
            except (OverflowError, struct.error):
                raise AvroError(f"{where}: {x!r} is too large for a {kind}") from None

        return checked(real)
    if kind == "string":
        return checked(lambda x, out: sized(x.encode(), out))
    if kind == "bytes":
        return checked(sized)
    if kind == "boolean":
        return checked(lambda x, out: out.append(x))
    if kind == "enum":
        place = {s: k for k, s in enumerate(schema["symbols"])}
        return checked(lambda x, out: _write_long(place[x], out))
    if kind == "fixed":

        def fixed(x, out):
            if len(x) != schema["size"]:
                raise AvroError(f"{where}: {len(x)} bytes instead of {schema['size']}")
            out += x

        return checked(fixed)
    if kind == "record":
        fields = [(f["name"], _writer(f["type"], f["name"]), "default" in f, f.get("default")) for f in schema["fields"]]

        def record(x, out):
            for name, write, has, default in fields:
                if name not in x and not has:
                    raise AvroError(f"{name} is absent")
                write(x.get(name, default), out)

        return checked(record)
    item = _writer(schema["items"] if kind == "array" else schema["values"], where)

    def blocks(x, out):
        pairs = x if kind == "array" else dict(x).items()
        if pairs:
            _write_long(len(pairs), out)
            for one in pairs:
                if kind == "map":
                    sized(one[0].encode(), out)
                    one = one[1]
                item(one, out)
        out.append(0)

    return checked(blocks)


class Codec:
    """Encodes and decodes records of one schema."""

    def __init__(self, schema: str | dict):
        self.schema = resolved(schema)
        self._read, self._write = _reader(self.schema), _writer(self.schema)

    def decode(self, raw: bytes) -> dict:
        """The record; bytes that are left over are an error, as is an end too early."""
        made, at = self._read(raw, 0)
        if at != len(raw):
            raise AvroError(f"{len(raw) - at} bytes too many")
        return made

    def encode(self, record: dict) -> bytes:
        out = bytearray()
        self._write(record, out)
        return bytes(out)


# Containers.
_HEAD = {"type": "map", "values": "bytes"}


def _head(schema: str | dict, sync: bytes, codec: str) -> bytearray:
    out = bytearray(MAGIC)
    _writer(_HEAD)({"avro.schema": json.dumps(schema if isinstance(schema, dict) else json.loads(schema)).encode(), "avro.codec": codec.encode()}, out)
    return out + sync


def _block(n: int, block: bytes, codec: str) -> bytearray:
    """A block of n encoded records, without the mark that follows it."""
    if codec == "deflate":
        squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
        block = squeeze.compress(block) + squeeze.flush()
    out = bytearray()
    _write_long(n, out)
    _write_long(len(block), out)
    return out + block


def container(schema: str | dict, records: list[dict], sync: bytes, codec: str = "deflate") -> bytes:
    """A container file of these records in blocks; sync are its 16 bytes of marks."""
    own, out = Codec(schema), _head(schema, sync, codec)
    for at in range(0, len(records), BLOCK_RECORDS):
        some = records[at : at + BLOCK_RECORDS]
        out += _block(len(some), b"".join(map(own.encode, some)), codec) + sync
    return bytes(out)


def read_container(raw: bytes, schema: str | dict | None = None) -> Iterator[dict]:
    """Records of a container file, by its own schema or one that must be the same type for type."""
    if raw[:4] != MAGIC:
        raise AvroError("not an Avro container")
    head, at = _reader(_HEAD)(raw, 4)
    codec = head.get("avro.codec", b"null").decode()
    if codec not in ("null", "deflate"):
        raise AvroError(f"codec {codec} is not known here")
    own = Codec(head["avro.schema"].decode())
    if schema is not None and spark_type(resolved(schema)) != spark_type(own.schema):
        raise AvroError("a container of another schema")
    sync, at = raw[at : at + 16], at + 16
    while at < len(raw):
        n, at = _read_long(raw, at)
        block, at = _read_bytes(raw, at)
        if raw[at : at + 16] != sync:
            raise AvroError("a block without its mark")
        at += 16
        block, place = (zlib.decompress(block, -15) if codec == "deflate" else block), 0
        for _ in range(n):
            record, place = own._read(block, place)
            yield record


# Data frames.
def _arrow(of: StructType) -> pa.Schema:
    return to_arrow_schema(of)


def decode_payload(df: DataFrame, payload: str, schema: str | dict, tolerant: bool = False) -> DataFrame:
    """The columns of the records in a binary column, and df's other columns (which win where names clash, as topic and time do).

    A null payload gives nulls. Bytes that are no such record end the job, or give nulls if tolerant.
    """
    fields = spark_type(resolved(schema))[0]
    others = [f for f in df.schema if f.name != payload]
    named = {f.name for f in others}
    kept = [f for f in fields if f.name not in named]
    plain = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate([*others, *kept])])
    types, names = _arrow(plain), [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Codec(schema)
        for batch in batches:
            records = []
            for one in batch.column(0):
                try:
                    records.append(own.decode(one.as_py()) if one.is_valid else {})
                except AvroError:
                    if not tolerant:
                        raise
                    records.append({})
            cols = [pa.array([r.get(n) for r in records], types.field(len(others) + k).type) for k, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *cols], names=plain.names)

    chosen = df.select(F.col(f"`{payload}`"), *[F.col(f"`{f.name}`") for f in others])
    return chosen.mapInArrow(run, plain).toDF(*[f.name for f in others], *names)


def encode_payload(df: DataFrame, schema: str | dict, keep: tuple[str, ...] = (), name: str = "value", tolerant: bool = False) -> DataFrame:
    """Columns keep and the record of the schema's fields, by name, as a binary column.

    A record that doesn't fit its schema ends the job, or has a null payload if tolerant, so that failures can be counted.
    """
    fields = [f["name"] for f in resolved(schema)["fields"]]
    plain = StructType([*(StructField(f"c{k}", df.schema[c].dataType) for k, c in enumerate(keep)), StructField("payload", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Codec(schema)
        for batch in batches:
            values = [batch.column(len(keep) + k).to_pylist() for k in range(len(fields))]
            made = []
            for row in zip(*values, strict=True):
                try:
                    made.append(own.encode(dict(zip(fields, row, strict=True))))
                except AvroError:
                    if not tolerant:
                        raise
                    made.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(made, pa.binary())], names=plain.names)

    return df.select(*keep, *fields).mapInArrow(run, plain).toDF(*keep, name)


def read_avro(spark: SparkSession, path: str, schema: str | dict) -> DataFrame:
    """Records of all containers under a path; a path without any gives no rows, and other files are not looked at."""
    fields = spark_type(resolved(schema))[0]
    if not path_exists(spark, path):
        return spark.createDataFrame([], fields)
    types = _arrow(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                records = []
                for record in read_container(raw.as_py(), schema):
                    records.append(record)
                    if len(records) == BLOCK_RECORDS:
                        yield pa.RecordBatch.from_pylist(records, schema=types)
                        records = []
                if records:
                    yield pa.RecordBatch.from_pylist(records, schema=types)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 4").select("content")
    return files.where(F.substring("content", 1, 4) == F.lit(MAGIC)).mapInArrow(run, fields)


def write_avro(df: DataFrame, path: str, schema: str | dict) -> DataFrame:
    """Overwrites path with containers, some for each partition; returns a row for each container: partition, container, record_count, bytes.

    Only the schema's fields are written, by name; what df lacks is null. An empty partition has no container. A
    container ends at FILE_BYTES, and a task holds its blocks, encoded and compressed, never the records. Rows of the result come from a table beside it.
    """
    spark, names = df.sparkSession, [f["name"] for f in resolved(schema)["fields"]]
    made = fresh_path(spark, "containers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, partition = Codec(schema), TaskContext.get().partitionId()
        out, block, in_block, count, held, n = None, bytearray(), 0, 0, 0, 0

        for batch in batches:
            for record in batch.rename_columns(names).to_pylist():
                if out is None:
                    # A container ends with its mark, and the mark with a line end, which Spark's writer puts after each row.
                    sync = hashlib.sha256(b"%d %d" % (partition, n)).digest()[:15] + b"\n"
                    out = _head(schema, sync, "deflate")
                encoded = own.encode(record)
                block += encoded
                in_block, count, held = in_block + 1, count + 1, held + len(encoded)
                if in_block == BLOCK_RECORDS or held >= FILE_BYTES:
                    out += _block(in_block, bytes(block), "deflate") + sync
                    block, in_block = bytearray(), 0
                if held >= FILE_BYTES:
                    yield file(partition, n, count, out)
                    out, count, held, n = None, 0, 0, n + 1
        if out is not None:
            if in_block:
                out += _block(in_block, bytes(block), "deflate") + sync
            yield file(partition, n, count, out)

    def file(partition: int, n: int, count: int, whole: bytearray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([partition]), pa.array([n]), pa.array([count]), pa.array([len(whole)]), pa.array([bytes(whole[:-1])], pa.binary())], names=["partition", "container", "record_count", "bytes", "content"])

    shape = "partition bigint, container bigint, record_count bigint, bytes bigint, content binary"
    in_order(df, names).mapInArrow(run, shape).write.parquet(made)
    rows = spark.read.schema(shape).parquet(made)
    # The text writer puts a string's bytes out as they are: this makes it a writer of binary files, one for each row.
    rows.select(F.col("content").cast("string").alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
    return rows.drop("content")


def write_enforced(found: Enforced, path: str, schema: str | dict) -> DataFrame:
    """Containers of the valid rows; a row for each partition: record_count, rejected_version_drift, rejected_round_trip_failed, data_loss_pct.

    A partition whose rows are all rejected has no container.
    """
    part = found.judged.withColumn("partition", F.spark_partition_id().cast("bigint")).groupBy("partition")
    drift = F.col("reason") == "version drift"
    counts = part.agg(F.count(F.lit(1)).alias("n"), F.count_if(drift).alias("rejected_version_drift"), F.count_if(F.col("reason").isNotNull() & ~drift).alias("rejected_round_trip_failed"))
    written = write_avro(found.valid, path, schema).groupBy("partition").agg(F.sum("record_count").alias("record_count"), F.count(F.lit(1)).alias("containers"))
    rejected = F.col("rejected_version_drift") + F.col("rejected_round_trip_failed")
    return counts.join(written, "partition", "left").select(
        "partition", F.coalesce("containers", F.lit(0)).alias("containers"), F.coalesce("record_count", F.lit(0)).alias("record_count"), "rejected_version_drift", "rejected_round_trip_failed",
        F.bround(rejected * 100.0 / F.col("n"), 4).alias("data_loss_pct"),
    )


def parquet_to_avro(spark: SparkSession, source: str, path: str, schema: str | dict) -> int:
    """A dataset's rows as containers, some for each partition, fields in the schema's order and null where it lacks them; returns how many."""
    fields = spark_type(resolved(schema))[0]
    rows = spark.read.parquet(source) if path_exists(spark, source) else spark.createDataFrame([], fields)
    return write_avro(rows, path, schema).agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0]


def avro_to_parquet(spark: SparkSession, source: str, path: str, schema: str | dict, by: list[str] | None = None) -> int:
    """Containers of one family as a dataset, apart by columns if asked; returns the rows, and writes nothing if there are none."""
    rows = read_avro(spark, source, schema)
    return write_parquet(rows, path, by) if not rows.isEmpty() else 0
