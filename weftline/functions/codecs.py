"""Wire formats of streams and tagged JSON, as expressions over binary columns.

Encoding and decoding stay in the JVM: lengths are written and read through hex,
chunk lists are folded with higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.operators.streams import MAX_CHUNKS

#: Fixed values of the formats: magic numbers, version, header sizes, states on the wire.
WRITE_MAGIC, ACK_MAGIC, READ_MAGIC, VERSION = 0x57435357, 0x57435341, 0x57435352, 1
WRITE_HEADER, ACK_BYTES, READ_HEADER = 8, 16, 28
STATES = ("open", "closed", "errored", "expired")
#: Characters of an error's name and message, bytes of both, step of the cut.
ERROR_NAME, ERROR_MESSAGE, ERROR_BYTES = 1024, 4096, 16 * 1024


def _be(number: Column | int, size: int) -> Column:
    """A number as ``size`` big-endian bytes."""
    number = F.lit(number) if isinstance(number, int) else number
    return F.unhex(F.substring(F.lpad(F.hex(number.cast("long")), 16, "0"), -2 * size, 2 * size))


def _number(data: Column, at: Column | int, size: int) -> Column:
    """The big-endian number of ``size`` bytes at a byte offset from 0; null beyond the end."""
    at = F.lit(at) if isinstance(at, int) else at
    part = F.substr(data, (at + 1).cast("int"), F.lit(size))
    return F.when(F.octet_length(part) == size, F.conv(F.hex(part), 16, 10).cast("long"))


def _framed(chunks: Column) -> Column:
    """Chunks with their lengths before them, one after another."""
    return F.aggregate(chunks, F.unhex(F.lit("")), lambda out, c: F.concat(out, _be(F.octet_length(c), 4), c))


def _unframed(data: Column, count: Column, start: int) -> Column:
    """struct(out: chunks, at: offset behind them); at is null where a length or chunk is cut off."""
    zero = F.struct(F.array().cast("array<binary>").alias("out"), F.lit(start).cast("long").alias("at"))

    def step(acc: Column, _: Column) -> Column:
        size = _number(data, acc["at"], 4)
        chunk = F.substr(data, (acc["at"] + 5).cast("int"), size.cast("int"))
        whole = size.isNotNull() & (F.octet_length(chunk) == size)
        return F.struct(
            F.when(whole, F.concat(acc["out"], F.array(chunk))).otherwise(acc["out"]).alias("out"),
            F.when(whole, acc["at"] + 4 + size).cast("long").alias("at"),
        )

    steps = F.when(count.between(1, MAX_CHUNKS), F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, zero, step)


def encode_write(chunks: Column) -> Column:
    """A write batch: magic, version, count, then framed chunks."""
    return F.concat(_be(WRITE_MAGIC, 4), _be(VERSION, 2), _be(F.size(chunks), 2), _framed(chunks))


def decode_write(data: Column) -> Column:
    """Chunks of a write batch; null where magic, version, count or lengths are wrong."""
    count = _number(data, 6, 2)
    read = _unframed(data, count, WRITE_HEADER)
    valid = (_number(data, 0, 4) == WRITE_MAGIC) & (_number(data, 4, 2) == VERSION) & count.between(1, MAX_CHUNKS)
    return F.when(valid & (read["at"] == F.octet_length(data)), read["out"])


def encode_ack(start: Column, count: Column) -> Column:
    """A write's answer: magic, version, count, first and last index."""
    return F.concat(_be(ACK_MAGIC, 4), _be(VERSION, 2), _be(count, 2), _be(start, 4), _be(start + count - 1, 4))


def decode_ack(data: Column) -> Column:
    """struct(start, count, tail), or null where the frame or the indexes don't fit together."""
    count, start, tail = _number(data, 6, 2), _number(data, 8, 4), _number(data, 12, 4)
    valid = (F.octet_length(data) == ACK_BYTES) & (_number(data, 0, 4) == ACK_MAGIC) & (_number(data, 4, 2) == VERSION)
    valid = valid & count.between(1, MAX_CHUNKS) & (tail == start + count - 1)
    return F.when(valid, F.struct(start.alias("start"), count.alias("count"), tail.alias("tail")))


def encode_read(start: Column, tail: Column, chunks: Column, state: Column, timed_out: Column, name: Column, message: Column) -> Column:
    """A read's answer; name and message are empty where there is no error."""
    wire = F.array_position(F.array(*map(F.lit, STATES)), state) - 1
    named, told = F.encode(F.coalesce(name, F.lit("")), "UTF-8"), F.encode(F.coalesce(message, F.lit("")), "UTF-8")
    head = [_be(READ_MAGIC, 4), _be(VERSION, 1), _be(wire, 1), _be(timed_out.cast("int"), 1), _be(0, 1), _be(start, 4), _be(tail, 4)]
    return F.concat(*head, _be(F.size(chunks), 4), _be(F.octet_length(named), 4), _be(F.octet_length(told), 4), _framed(chunks), named, told)


def decode_read(data: Column) -> Column:
    """struct(start, tail, chunks, state, timed_out, name, message), or null for a broken frame."""
    count, n_name, n_message = (_number(data, at, 4) for at in (16, 20, 24))
    read = _unframed(data, count, READ_HEADER)
    state = F.try_element_at(F.array(*map(F.lit, STATES)), (_number(data, 5, 1) + 1).cast("int"))
    valid = (_number(data, 0, 4) == READ_MAGIC) & (_number(data, 4, 1) == VERSION) & state.isNotNull() & (count <= MAX_CHUNKS)
    valid = valid & (read["at"] + n_name + n_message == F.octet_length(data))
    name = F.decode(F.substr(data, (read["at"] + 1).cast("int"), n_name.cast("int")), "UTF-8")
    message = F.decode(F.substr(data, (read["at"] + n_name + 1).cast("int"), n_message.cast("int")), "UTF-8")
    told = n_name + n_message > 0

    def signed(at: int) -> Column:
        raw = _number(data, at, 4)
        return F.when(raw >= 2**31, raw - 2**32).otherwise(raw)

    return F.when(
        valid,
        F.struct(
            signed(8).alias("start"), signed(12).alias("tail"), read["out"].alias("chunks"), state.alias("state"),
            (_number(data, 6, 1) % 2 == 1).alias("timed_out"), F.when(told, name).alias("name"), F.when(told, message).alias("message"),
        ),
    )


def bounded_error(name: Column, message: Column) -> tuple[Column, Column]:
    """Name and message cut to their bounds; by default the name is "Error".

    4,096 characters of message and 1,024 of name fit the byte bound unless most
    are four-byte characters; then the message is cut by 256 characters at a time.
    """
    name = F.substring(F.coalesce(F.when(name != "", name), F.lit("Error")), 1, ERROR_NAME)
    message = F.substring(F.coalesce(message, F.lit("")), 1, ERROR_MESSAGE)
    over = F.octet_length(name) + F.octet_length(message) > ERROR_BYTES
    cuts = F.transform(F.sequence(F.lit(0), F.lit(ERROR_MESSAGE // 256)), lambda i: F.substr(message, F.lit(1), F.greatest(F.length(message) - i * 256, F.lit(0))))
    fitting = F.filter(cuts, lambda m: F.octet_length(name) + F.octet_length(m) <= ERROR_BYTES)
    return name, F.when(over, F.element_at(fitting, 1)).otherwise(message)


def tagged(value: Column, kind: str) -> Column:
    """A date (epoch milliseconds) or bytes as a tagged JSON object."""
    if kind == "date":
        return F.to_json(F.struct(F.lit("date").alias("$type"), value.alias("value")))
    return F.to_json(F.struct(F.lit("bytes").alias("$type"), F.base64(value).alias("value")))


def untagged(text: Column, kind: str) -> Column:
    """Inverse of tagged; null for another tag."""
    fits = F.get_json_object(text, "$.$type") == kind
    raw = F.get_json_object(text, "$.value")
    return F.when(fits, raw.cast("long") if kind == "date" else F.unbase64(raw))
