"""Scalar expressions on columns: time, numbers, labels, requests and responses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalflow import schemas as S

ColumnOrName = Column | str

# Accepted layouts of the event-time text.
_FULL_TEXT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{0,9})?$"
_SECONDS_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _utc(text: Column) -> Column:
    """Cast text without a zone as UTC, whatever the session zone is."""
    return F.concat(text, F.lit("Z")).try_cast("timestamp")


def _now(now: Column | None) -> Column:
    return F.current_timestamp() if now is None else now


def parsed_event_time(text: ColumnOrName) -> Column:
    """Event-time text (UTC, 0-9 fraction digits) as a millisecond timestamp; null if unreadable.

    Days past the end of a month fall on its last day and 24:00:00 is the next midnight; those
    rows and a bare trailing point take the second, slower branch.
    """
    c = _col(text)
    month_start = F.concat(F.substring(c, 1, 7), F.lit("-01")).try_cast("date")
    day = F.substring(c, 9, 2).try_cast("int")
    hour = F.substring(c, 12, 2).try_cast("int")
    last_day = F.dayofmonth(F.last_day(month_start))
    date_text = F.concat(
        F.substring(c, 1, 8), F.lpad(F.least(day, last_day).cast("string"), 2, "0")
    )
    clock = F.regexp_replace(F.substring(c, 12, 18), r"\.$", "")
    midnight = (hour == 24) & clock.rlike(r"^24:00:00(\.0*)?$")
    lenient = F.when((day >= 1) & (day <= 31), F.when(
        midnight, _utc(F.concat(date_text, F.lit(" 00:00:00"))) + F.expr("INTERVAL 1 DAY")
    ).otherwise(_utc(F.concat(date_text, F.lit(" "), clock))))
    found = F.when(c.rlike(_FULL_TEXT), F.coalesce(_utc(c), lenient))
    return F.timestamp_millis(F.unix_millis(found))


def parse_event_time(text: ColumnOrName, now: Column | None = None) -> Column:
    """`parsed_event_time`, with the current time where the text is missing or unreadable."""
    return F.coalesce(parsed_event_time(text), _now(now))


def parse_event_time_seconds(text: ColumnOrName, now: Column | None = None) -> Column:
    """Event-time text cut at the first point, as epoch ms; the current time if unreadable."""
    whole = F.substring_index(_col(text), ".", 1)
    found = F.unix_millis(F.when(whole.rlike(_SECONDS_TEXT), _utc(whole)))
    return F.coalesce(found, F.unix_millis(_now(now)))


def format_event_time(ts: ColumnOrName) -> Column:
    """Timestamp as text with milliseconds; finer digits are cut."""
    return F.date_format(_col(ts), S.TIME_FORMAT)


def to_epoch_nanos(ms: ColumnOrName) -> Column:
    return _col(ms).cast("bigint") * F.lit(1_000_000).cast("bigint")


def null_as_zero(value: ColumnOrName) -> Column:
    return F.coalesce(_col(value).cast("double"), F.lit(0.0))


def nan_as_null(value: ColumnOrName) -> Column:
    """Missing readings may arrive as NaN; a skip-missing mean must not count them."""
    c = _col(value).cast("double")
    return F.when(~F.isnan(c), c)


def empty_as_null(text: ColumnOrName, dtype: str = "double") -> Column:
    """Empty text is a missing reading; other text must be a number, else the query fails."""
    c = _col(text)
    number = F.when(c != "", c).try_cast(dtype)
    wrong = F.raise_error(F.concat(F.lit("not a number: "), c)).cast(dtype)
    return F.when((c != "") & number.isNull(), wrong).otherwise(number)


def stress_label(level: ColumnOrName, default: str = S.UNKNOWN_LABEL) -> Column:
    c = _col(level)
    out = F.when(c == S.CLASSES[0], S.STRESS_LABELS[S.CLASSES[0]])
    for cls in S.CLASSES[1:]:
        out = out.when(c == cls, S.STRESS_LABELS[cls])
    return out.otherwise(default)


def threshold_band(
    value: ColumnOrName,
    steps: Sequence[tuple[float, str]] = ((1, "yellow"), (2, "red")),
    base: str = "green",
) -> Column:
    """Name of the highest step reached; values below every step, and nulls, get `base`."""
    c = _col(value)
    out = F.lit(base)
    for limit, name in sorted(steps):
        out = F.when(c >= limit, F.lit(name)).otherwise(out)
    return out


def sensor_band(value: ColumnOrName) -> Column:
    return threshold_band(value, ((80, "red"),))


def fallback_status(count: ColumnOrName) -> Column:
    """Text of the status panel; counts outside both mappings have none."""
    c = _col(count)
    return F.when(c == 0, "Normal").when(c.between(1, 999_999), "Fallback Active")


def parse_prediction(body: ColumnOrName) -> Column:
    """Class in a response body; the text may be `2` or `2.0`. Null if absent or not a number."""
    number = F.get_json_object(_col(body), "$.stress_level_prediction").try_cast("double")
    whole = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number))
    return whole.try_cast("int")


def feature_text(features: Sequence[str] = S.SENSORS) -> Column:
    """Six-decimal request parameters, names in lower case."""
    names = [c.lower() for c in features]
    return F.format_string("&".join(f"{n}=%f" for n in names), *[F.col(c) for c in features])


def feature_text_plain(features: Sequence[str] = S.SENSORS) -> Column:
    """Request parameters with the numbers' own text, unrounded."""
    parts = [F.concat(F.lit(f"{c.lower()}="), F.col(c).cast("string")) for c in features]
    return F.concat_ws("&", *parts)


def wire_value(value: ColumnOrName) -> Column:
    """The number a receiver of the six-decimal text sees."""
    return F.format_string("%f", _col(value)).cast("double")


def prediction_response(prediction: ColumnOrName, model: ColumnOrName) -> Column:
    """Response struct: class as text, its label, the model key and the echoed inputs."""
    level = _col(prediction)
    return F.struct(
        level.cast("string").alias("stress_level_prediction"),
        stress_label(level).alias("stress_label"),
        _col(model).alias("model"),
        F.struct(*[F.col(c).cast("double").alias(c.lower()) for c in S.SENSORS]).alias("inputs"),
    )


def label_delta(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.abs(_col(a) - _col(b))


def model_key(text: ColumnOrName) -> Column:
    """Requested model: lower case, trimmed; the default when absent."""
    return F.trim(F.lower(F.coalesce(_col(text), F.lit(S.DEFAULT_MODEL))))


def request_number(text: ColumnOrName) -> Column:
    """Decimal number in request text; null otherwise, also for hex and type-suffixed numbers."""
    c = _col(text).cast("string")
    return F.when(~c.rlike(r"(?i)0x|[\d.][fd]\s*$"), c.try_cast("double"))


def request_error(params: Mapping[str, ColumnOrName], model: ColumnOrName) -> Column:
    """Null for a valid request, else why it is refused: bad parameter first, then bad model."""
    bad = F.when(F.lit(False), "")
    for name, c in params.items():
        bad = bad.when(
            request_number(c).isNull(), S.BAD_PARAMETER + name
        )
    key = model_key(model)
    unknown = F.when(
        ~key.isin(*S.MODEL_KEYS),
        F.concat(
            F.lit(S.BAD_MODEL[0]),
            key,
            F.lit(S.BAD_MODEL[1]),
        ),
    )
    return F.coalesce(bad, unknown)


def stable_hash(key: ColumnOrName, seed: int = 42) -> Column:
    """Multiplicative hash into 0..2^32-1 with the same value in every SQL engine.

    The key is taken in two 31-bit halves so that no product leaves 64 bits.
    """
    c = _col(key).cast("bigint") + F.lit(seed).cast("bigint")
    half, size = F.lit(2_147_483_648), F.lit(4_294_967_296)
    low = F.pmod(F.pmod(c, half) * F.lit(2_654_435_761), size)
    high = F.pmod(F.pmod(F.floor(c / half), half) * F.lit(2_246_822_519), size)
    return F.pmod(low + high, size)
