"""Column builders for keys, hashes, clocks and codec-free scalars."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the two hash variants (32-bit FNV-1a).
FNV_OFFSET, FNV_PRIME, MASK32 = 0x811C9DC5, 0x01000193, 0xFFFFFFFF
#: How many shards each index is dealt over.
CATALOG_SHARDS, TOKEN_SHARDS, HOOK_SHARDS = 16, 32, 32
#: Fixed values of the delivery and cleanup backoffs (seconds; milliseconds).
BACKOFF_CAP_S, CLEANUP_BASE_MS, CLEANUP_CAP_MS, CLEANUP_MAX_EXPONENT = 60, 1_000, 3_600_000, 12


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    day = F.unix_date(ts.cast("date")).cast("long") * 86_400_000_000
    seconds = F.hour(ts).cast("long") * 3600 + F.minute(ts) * 60 + F.second(ts)
    fraction = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long") % 1_000_000
    return day + seconds * 1_000_000 + fraction


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970, floored."""
    return F.floor(epoch_micros(ts) / F.lit(1000)).cast("long")


def padded_ms(ms: Column) -> Column:
    """Floored, not below 0, 13 digits: sorts as a string like the number."""
    return F.lpad(F.greatest(F.floor(ms), F.lit(0)).cast("long").cast("string"), 13, "0")


def ms_of_padded(key: Column, start: int = 1) -> Column:
    """Inverse of padded_ms inside a longer key; start counts characters from 1."""
    return F.substring(key, start, 13).cast("long")


def iso_ms(ts: Column) -> Column:
    """ISO form in milliseconds, UTC, of a timestamp without zone."""
    ms = F.lpad((epoch_millis(ts) % 1000).cast("string"), 3, "0")
    return F.concat(F.date_format(ts.cast("date"), "yyyy-MM-dd"), F.lit("T"), _clock(ts), F.lit("."), ms, F.lit("Z"))


def _clock(ts: Column) -> Column:
    return F.concat_ws(":", *(F.lpad(f(ts).cast("string"), 2, "0") for f in (F.hour, F.minute, F.second)))


def chunk_key(index: Column) -> Column:
    """12-digit chunk index."""
    return F.lpad(index.cast("string"), 12, "0")


def _fnv(units: list[np.ndarray]) -> np.ndarray:
    """FNV-1a of many sequences of units at once, position by position."""
    sizes = np.array([len(u) for u in units], int)
    out = np.full(len(units), FNV_OFFSET, np.uint64)
    order = np.argsort(-sizes, kind="stable")
    flat, starts = np.concatenate([np.empty(0, np.uint64), *units]), np.cumsum(sizes) - sizes
    live = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), "left")  # how many are longer than each position
    for at, n in enumerate(live):
        rows = order[:n]
        out[rows] = ((out[rows] ^ flat[starts[rows] + at]) * np.uint64(FNV_PRIME)) & np.uint64(MASK32)
    return out.astype(np.int64)


@F.pandas_udf(T.LongType())
def _fnv_bytes(texts: pd.Series) -> pd.Series:
    hashed = pd.Series(_fnv([np.frombuffer((t or "").encode(), np.uint8).astype(np.uint64) for t in texts]), dtype="Int64")
    return hashed.mask(texts.isna().to_numpy())


@F.pandas_udf(T.LongType())
def _fnv_units(texts: pd.Series) -> pd.Series:
    hashed = pd.Series(_fnv([np.frombuffer((t or "").encode("utf-16-le", "surrogatepass"), "<u2").astype(np.uint64) for t in texts]), dtype="Int64")
    return hashed.mask(texts.isna().to_numpy())


def fnv1a_bytes(text: Column) -> Column:
    """FNV-1a over the UTF-8 bytes, as a non-negative long; null for null. Arrow batches, since the JVM would interpret every byte."""
    return _fnv_bytes(text)


def fnv1a_utf16(text: Column) -> Column:
    """FNV-1a over UTF-16 code units: differs from fnv1a_bytes beyond ASCII."""
    return _fnv_units(text)


def uri_component(text: Column) -> Column:
    """Percent-encoding of one key component: letters, digits and - _ . ! ~ * ' ( ) stay."""
    out = F.regexp_replace(F.url_encode(text), r"\+", "%20")
    for code, char in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def index_key(*parts: Column) -> Column:
    """Components of a hook's or marker's key, each encoded, joined by colons."""
    return F.concat_ws(":", *map(uri_component, parts))


def compact(**fields: Column) -> Column:
    """JSON of the fields that are there: a null field is absent, not null."""
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())), {"ignoreNullFields": "true"})


#: What a reject code becomes for the caller: an error's name, and the status it carries where it carries one.
ERRORS = {
    "RUN_NOT_FOUND": ("RunNotFoundError", None), "STEP_NOT_FOUND": ("StatusError", 404), "HOOK_NOT_FOUND": ("HookNotFoundError", None),
    "WAIT_NOT_FOUND": ("StatusError", 404), "ENTITY_CONFLICT": ("EntityConflictError", None), "HOOK_CLAIM_CANCELLED": ("StatusError", 503),
    "RUN_EXPIRED": ("RunExpiredError", None), "TOO_EARLY": ("TooEarlyError", None), "RUN_NOT_SUPPORTED": ("RunNotSupportedError", None),
}


def error_of(outcome: Column) -> tuple[Column, Column]:
    """Error name and status of an outcome; both null for success."""
    name, status = F.lit(None).cast("string"), F.lit(None).cast("int")
    for code, (error, number) in ERRORS.items():
        name = F.when(outcome == code, error).otherwise(name)
        status = F.when(outcome == code, F.lit(number).cast("int")).otherwise(status)
    return name, status


def shard_name(domain: str, value: Column, cardinality: int) -> Column:
    """``<domain>:v1:<hex>`` with at least two digits."""
    return F.concat(F.lit(f"{domain}:v1:"), F.lower(F.lpad(F.hex(fnv1a_bytes(value) % cardinality), 2, "0")))


def queue_shard(key: Column, shards: int) -> Column:
    """Shard of a queue message; 0 when there is one shard or none."""
    return fnv1a_utf16(key) % shards if shards > 1 else F.lit(0).cast("long")


def backoff_seconds(attempt: Column) -> Column:
    """min(60, 2^attempt)."""
    return F.least(F.lit(BACKOFF_CAP_S), F.pow(F.lit(2.0), F.least(attempt, F.lit(10)))).cast("long")


def cleanup_backoff_ms(attempts: Column) -> Column:
    """min(1 h, 1 s * 2^min(attempts - 1, 12))."""
    steps = F.least(attempts - 1, F.lit(CLEANUP_MAX_EXPONENT))
    return F.least(F.lit(CLEANUP_CAP_MS), F.lit(CLEANUP_BASE_MS) * F.pow(F.lit(2.0), steps)).cast("long")


def retry_after_seconds(retry_after_ms: Column, now_ms: Column) -> Column:
    return F.ceil((retry_after_ms - now_ms) / 1000).cast("long")


def bounded(value: Column, fallback: int, most: int, least: int = 1) -> Column:
    """A page limit: null or NaN gives the fallback, others are floored and held within bounds."""
    number = F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(fallback)).otherwise(F.floor(value))
    return F.greatest(F.lit(least), F.least(F.lit(most), number)).cast("long")


#: Fixed value: the largest whole number that a double tells from its neighbours.
SAFE_INTEGER = 2**53 - 1


def integer_setting(raw: Column, fallback: int, least: int, most: int = SAFE_INTEGER) -> Column:
    """A setting from its text: the fallback for none or an empty one, null for what is no whole number within the bounds.

    Blanks around a number don't count, and blanks alone are 0; a number may be written with a fraction of zeros or an exponent.
    """
    text = F.regexp_replace(raw, r"^\s+|\s+$", "")
    number = F.when(text == "", F.lit(0.0)).otherwise(F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double")))
    number = F.when(raw.isNull() | (raw == ""), F.lit(float(fallback))).otherwise(number)
    fits = (number == F.floor(number)) & (F.abs(number) <= SAFE_INTEGER) & number.between(least, most)
    return F.when(fits, number.cast("long"))


def run_keys(run: dict[str, Column]) -> tuple[Column, Column]:
    """The two catalog keys of a run: by workflow and over all."""
    ms = padded_ms(epoch_millis(run["created_at"]))
    return F.concat_ws(":", F.lit("run"), run["workflow_name"], ms, run["run_id"]), F.concat_ws(":", F.lit("runall"), ms, run["run_id"])


def structured_error(message: Column, nested_message: Column | None = None) -> Column:
    """An error's message: itself, else its message property, else "Unknown error"."""
    found = [message] + ([nested_message] if nested_message is not None else [])
    return F.coalesce(*found, F.lit("Unknown error"))
