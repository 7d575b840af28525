"""What every model offers: put a class on rows that carry the six features."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from threading import Condition, Lock, Thread
from typing import Protocol

import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalflow import schemas as S
from vitalflow.functions import scalars as fn


#: Rows of later frames whose calls are made while a frame waits for its last answers.
AHEAD_ROWS = 100_000
#: So many times its time a call may take until nobody waits for its place any more.
PATIENCE = 10


class Model(Protocol):
    def score(self, df: DataFrame, out: str) -> DataFrame: ...


@dataclass(frozen=True)
class RuleModel:
    """A fixed decision over the features, as an expression."""

    decide: Callable[[], Column]

    def score(self, df: DataFrame, out: str = "stress_level") -> DataFrame:
        return df.withColumn(out, self.decide().cast("int"))


def assemble_features(df: DataFrame, out: str = "features") -> DataFrame:
    """Feature vector in model order; a missing feature becomes NaN."""
    doubles = df.withColumns({f"_f_{c}": F.col(c).cast("double") for c in S.FEATURES})
    assembler = VectorAssembler(
        inputCols=[f"_f_{c}" for c in S.FEATURES], outputCol=out, handleInvalid="keep"
    )
    return assembler.transform(doubles).drop(*[f"_f_{c}" for c in S.FEATURES])


def score_batch(
    df: DataFrame, models: Mapping[str, Model], model: str = S.DEFAULT_MODEL, out: str = "prediction"
) -> DataFrame:
    """Class of every row by the chosen model."""
    return models[model].score(df, out)


def score_requests(requests: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """Responses to validated requests: each row by the model it names, or its error.

    `requests` has the six lower-case parameters, `model` and `error`.
    """
    named = requests.withColumnsRenamed({c.lower(): c for c in S.SENSORS})
    for key, model in models.items():
        named = model.score(named, f"_by_{key}")
    chosen = F.when(F.lit(False), F.lit(None).cast("int"))
    for key in models:
        chosen = chosen.when(F.col("model") == key, F.col(f"_by_{key}"))
    valid = F.col("error").isNull()
    return named.withColumn("_class", F.when(valid, chosen)).select(
        *[c for c in requests.columns if c not in {s.lower() for s in S.SENSORS}],
        F.when(valid, fn.prediction_response("_class", "model")).alias("response"),
    )


def compare_models(df: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """Predictions of two models side by side, whether they agree, and by how much they differ."""
    (key_a, a), (key_b, b) = models.items()
    col_a, col_b = f"pred_{key_a}", f"pred_{key_b}"
    both = b.score(a.score(df, col_a), col_b)
    return both.withColumn("agree", F.col(col_a).eqNullSafe(F.col(col_b))).withColumn(
        "delta", fn.label_delta(col_a, col_b)
    )


def with_default(df: DataFrame, prediction: str = "stress_level") -> DataFrame:
    """Fill missing predictions with the moderate class and say where that was done."""
    missing = F.col(prediction).isNull()
    return df.withColumn("was_default", missing).withColumn(
        prediction, F.coalesce(F.col(prediction), F.lit(S.DEFAULT_CLASS)).cast("int")
    )


def complete_only(df: DataFrame, model: Model, out: str = "stress_level") -> DataFrame:
    """Score by `model`, leaving rows with a missing feature without a class."""
    complete = F.lit(True)
    for c in S.FEATURES:
        complete = complete & fn.nan_as_null(c).isNotNull()
    return model.score(df, out).withColumn(out, F.when(complete, F.col(out)))


def score_remote(
    df: DataFrame,
    ask: Callable[[str, float], str],
    out: str = "stress_level",
    timeout_s: float = S.SCORE_TIMEOUT_S,
    in_flight: int = S.SCORE_IN_FLIGHT,
    attempts: int = 1,
    default: int | None = None,
    request: Column | None = None,
) -> DataFrame:
    """Score by calling `ask` with the request text and the seconds it may take, for models behind
    an endpoint.

    The text has six decimals unless another `request` column is given.

    Each task has `in_flight` places for calls, and emits rows in order. A call has `timeout_s` from
    when it is sent. One that fails or takes longer is tried `attempts` times; then the row gets
    `default`, or the task fails if there is none. Rows behind it, up to AHEAD_ROWS, do not wait for
    that. A call that outlives its time keeps its place until it ends, so the endpoint never has
    more calls than places. Requests wait for a place. Only when each is held by a call that has
    taken PATIENCE times its time, they fail without being sent, until a place comes free.
    """
    asked = df.withColumn("_request", fn.feature_text() if request is None else request)
    schema = T.StructType([*df.schema.fields, T.StructField("_body", T.StringType())])
    kept = df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        calls = _Calls(ask, timeout_s, in_flight, attempts, default is not None)
        sent: deque[tuple[pd.DataFrame, _Answers]] = deque()
        try:
            for frame in frames:
                sent.append((frame[kept], calls.send(list(frame["_request"]))))
                while sent and (not sent[0][1].left or sum(len(f) for f, _ in sent) > AHEAD_ROWS):
                    first, answers = sent.popleft()
                    yield first.assign(_body=calls.told(answers))
            for first, answers in sent:
                yield first.assign(_body=calls.told(answers))
        finally:
            calls.close()

    answered = asked.mapInPandas(run, schema)
    level = fn.parse_prediction("_body")
    if default is not None:
        level = F.coalesce(level, F.lit(default))
    return answered.withColumn(out, level).drop("_body")


def _ordered_calls(
    ask: Callable[[str, float], str],
    requests: Sequence[str],
    timeout_s: float,
    in_flight: int,
    attempts: int,
    may_fail: bool,
) -> list[str | None]:
    """Answers in the order of the requests, None where all attempts failed."""
    calls = _Calls(ask, timeout_s, in_flight, attempts, may_fail)
    try:
        return calls.told(calls.send(requests))
    finally:
        calls.close()


class _Answers:
    """Answers to some requests, as they come; `left` are still missing."""

    def __init__(self, requests: Sequence[str]):
        self.requests, self.left = requests, len(requests)
        self.bodies: list[str | None] = [None] * len(requests)
        self.error: BaseException | None = None


@dataclass
class _Call:
    """One call that holds a place, for which nobody waits once it is `late`."""

    answers: _Answers
    at: int
    attempt: int
    began: float
    late: bool = False


class _Calls:
    """The places of a task: threads, each of which makes one call after the other."""

    def __init__(
        self, ask: Callable[[str, float], str], timeout_s: float, in_flight: int, attempts: int, may_fail: bool
    ):
        self.ask, self.timeout_s, self.in_flight = ask, timeout_s, in_flight
        self.attempts, self.may_fail = attempts, may_fail
        self.waiting: deque[tuple[_Answers, int, int]] = deque()
        self.running: dict[int, _Call] = {}
        self.places, self.closed = 0, False
        self.lock = Lock()
        self.some_wait, self.some_told = Condition(self.lock), Condition(self.lock)

    def send(self, requests: Sequence[str]) -> _Answers:
        answers = _Answers(requests)
        with self.lock:
            self.waiting.extend((answers, at, 1) for at in range(len(requests)))
            self.some_wait.notify(len(requests))
            new = min(self.in_flight - self.places, len(requests))
            self.places += new
        for place in range(self.places - new, self.places):
            Thread(target=self._work, args=(place,), daemon=True).start()
        return answers

    def told(self, answers: _Answers) -> list[str | None]:
        """Wait until each request has its answer, or has failed."""
        with self.lock:
            while answers.left and answers.error is None:
                now = time.monotonic()
                for call in self.running.values():
                    if not call.late and now - call.began >= self.timeout_s:
                        call.late = True
                        self._settle(call.answers, call.at, call.attempt, None, TimeoutError("a call takes too long"))
                if self._freed_after(now) <= 0:
                    none = TimeoutError("all places are taken by calls that do not end")
                    while self.waiting:
                        own, at, _ = self.waiting.popleft()
                        self._settle(own, at, self.attempts, None, none)
                if answers.left and answers.error is None:
                    due = (c.began + self.timeout_s - now for c in self.running.values() if not c.late)
                    self.some_told.wait(max(0.001, min(self.timeout_s, self._freed_after(now), *due)))
        if answers.error is not None:
            raise answers.error
        return answers.bodies

    def close(self) -> None:
        """Places are given up as their calls end."""
        with self.lock:
            self.closed = True
            self.waiting.clear()
            self.some_wait.notify_all()

    def _freed_after(self, now: float) -> float:
        """Seconds that a request would still wait for a place; without end while one may come free."""
        calls = self.running.values()
        if len(calls) < self.in_flight or not all(c.late for c in calls):
            return float("inf")
        return max(c.began for c in calls) + PATIENCE * self.timeout_s - now

    def _settle(
        self, answers: _Answers, at: int, attempt: int, body: str | None, error: BaseException | None
    ) -> None:
        if error is not None and attempt < self.attempts:
            self.waiting.appendleft((answers, at, attempt + 1))
            self.some_wait.notify()
            return
        if error is not None and not self.may_fail:
            answers.error = answers.error or error
        answers.bodies[at] = body
        answers.left -= 1
        if not answers.left or answers.error is not None:
            self.some_told.notify_all()

    def _work(self, place: int) -> None:
        self.lock.acquire()
        while True:
            while not self.waiting:
                if self.closed:
                    self.lock.release()
                    return
                self.some_wait.wait()
            answers, at, attempt = self.waiting.popleft()
            call = self.running[place] = _Call(answers, at, attempt, time.monotonic())
            self.lock.release()
            body, error = None, None
            try:
                body = self.ask(answers.requests[at], self.timeout_s)
            except BaseException as e:  # noqa: BLE001 - a refused or late call counts the same
                error = e
            if time.monotonic() - call.began > self.timeout_s:
                body, error = None, error or TimeoutError("a call has taken too long")
            self.lock.acquire()
            del self.running[place]
            if not call.late:
                self._settle(answers, at, attempt, body, error)
