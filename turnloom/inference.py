"""The boundary to models: a callable applied to batches of jobs inside a task, with retries, results and traces as columns.

A judge or transcriber is given as ``load``: a function that runs once per task (it may hold a model or a connection)
and gives a function from a batch of inputs to a batch of replies, each a text or an exception.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib import request

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.operators import replies
from turnloom.operators.validators import REPLY

Load = Callable[[], Callable[[list], list]]

RESULT = "reply string, error string, attempts int, latency_s double"


def run_model(jobs: DataFrame, key: str, prompt: str, load: Callable[[], Callable[[list[str]], list[str | Exception]]], batch: int = 64, retries: int = 1, most_logged: int = 16_000) -> DataFrame:
    """(key, reply, error, attempts, latency_s): one row per job.

    ``load`` runs once per task and gives a function from prompts to replies or exceptions. Failed jobs are gathered
    and tried again in full batches, so that retries leave no tail of single calls. Results aren't deterministic:
    write them before they are used twice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            keys, prompts = pdf[key].tolist(), pdf[prompt].tolist()
            done: dict[int, tuple] = {}
            open_jobs = list(range(len(keys)))
            for attempt in range(1, retries + 2):
                failed = []
                for at in range(0, len(open_jobs), batch):
                    part = open_jobs[at : at + batch]
                    began = time.monotonic()
                    try:
                        replies = model([prompts[j] for j in part])
                    except Exception as e:  # noqa: BLE001
                        replies = [e] * len(part)
                    took = (time.monotonic() - began) / max(1, len(part))
                    for j, r in zip(part, replies):
                        bad = isinstance(r, BaseException)
                        done[j] = (None if bad else r, str(r)[:most_logged] if bad else None, attempt, took)
                        if bad:
                            failed.append(j)
                open_jobs = failed
            yield pd.DataFrame([(keys[j], *done[j]) for j in range(len(keys))], columns=[key, "reply", "error", "attempts", "latency_s"])

    return jobs.select(key, F.col(prompt)).mapInPandas(run, f"{key} {dict(jobs.dtypes)[key]}, {RESULT}")


def api_base(url: str) -> str:
    """A base address without trailing slashes and with its version."""
    url = url.rstrip("/")
    return url if url.endswith("/v1") else url + "/v1"


def http_chat(url: str, model: str, system: str = "", workers: int = 8, timeout: float = 120.0, temperature: float = 0.0, key: str | None = None) -> Load:
    """A judge behind an HTTP endpoint for chat completions: prompts of a batch are sent by ``workers`` threads of the task."""
    address = api_base(url) + "/chat/completions"

    def load() -> Callable[[list[str]], list]:
        def ask(prompt: str) -> str | Exception:
            messages = [{"role": "system", "content": system}] * bool(system) + [{"role": "user", "content": prompt}]
            body = json.dumps({"model": model, "messages": messages, "temperature": temperature}).encode()
            headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
            try:
                with request.urlopen(request.Request(address, body, headers), timeout=timeout) as r:
                    return json.load(r)["choices"][0]["message"]["content"]
            except Exception as e:  # noqa: BLE001
                return e

        pool = ThreadPoolExecutor(workers)
        return lambda prompts: list(pool.map(ask, prompts))

    return load


def trace_rows(asked: DataFrame, judge: str, backend: str, name: str, key: str, most_logged: int = 16_000) -> DataFrame:
    """Rows of the trace log for asked jobs (key, prompt, reply, error, latency_s); long texts are cut for the log only."""
    text = F.coalesce("reply", F.lit(""))
    return asked.select(
        F.current_timestamp().alias("ts"), F.lit(judge).alias("judge"), F.lit(backend).alias("backend"), F.lit(name).alias("pass"), F.col(key).cast("string").alias("key"), F.col("error").isNull().alias("ok"), "latency_s",
        F.length("prompt").alias("user_chars"), F.length(text).alias("response_chars"), "error", F.left("prompt", F.lit(most_logged)).alias("user_text"), F.left(text, F.lit(most_logged)).alias("response"),
    )


def judged(jobs: DataFrame, key: str, load: Load, invalid: Callable[[Column], Column], work: str, retries: int = 1, judge: str = "judge", backend: str = "http", name: str = "A", batch: int = 64) -> DataFrame:
    """(key, tries): the replies of a model to jobs (key, prompt), in order, until one is valid or ``retries`` are used up.

    ``invalid`` gives the error of a reply or null. Each attempt is one distributed round over the jobs that are still
    open, so retries fill whole batches; its results are written under ``work`` before they are read again, since a
    model doesn't reply alike twice, and are added to the log ``trace`` beside it.
    """
    spark, open_jobs, rounds = jobs.sparkSession, jobs.select(key, "prompt"), []
    for attempt in range(retries + 1):
        path = f"{work}/replies_{name}_{attempt}"
        run_model(open_jobs, key, "prompt", load, batch, retries=0).join(open_jobs, key).write.mode("overwrite").parquet(path)
        got = spark.read.parquet(path)
        trace_rows(got, judge, backend, name, key).write.mode("append").parquet(f"{work}/trace")
        json_text = replies.extract_json(got, key, "reply").select(key, replies.parsed(F.col("json_text")).alias("parsed"))
        heard = got.join(json_text, key).select(key, "prompt", F.lit(attempt).alias("attempt"), F.col("parsed").alias("reply"))
        rounds.append(heard.select(key, "attempt", "reply"))
        open_jobs = heard.where(F.col("reply").isNull() | invalid(F.col("reply")).isNotNull()).select(key, "prompt")
    every = rounds[0]
    for r in rounds[1:]:
        every = every.unionByName(r)
    tries = F.array_sort(F.collect_list(F.struct("attempt", "reply")))
    return every.groupBy(key).agg(F.transform(tries, lambda x: x["reply"]).cast(f"array<{REPLY}>").alias("tries"))


def last_try(tries: DataFrame, key: str, invalid: Callable[[Column], Column]) -> DataFrame:
    """(key, reply): the first valid reply of each job, else its last one."""
    good = F.try_element_at(F.filter("tries", lambda r: r.isNotNull() & invalid(r).isNull()), F.lit(1))
    return tries.select(key, F.coalesce(good, F.try_element_at("tries", F.lit(-1))).alias("reply"))


def transcribed(clips: DataFrame, model: str, load: Callable[[], Callable[[list[bytes]], list]], key: str = "unit_key", batch: int = 16) -> DataFrame:
    """(key, model, text, lid, error): a transcriber over clips (key, wav); each result is a text, (text, language) or an exception.

    A clip that is null isn't heard and gives an error; other failures stay rows with their error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hear = load()
        for pdf in batches:
            keys, wavs, out = pdf[key].tolist(), pdf["wav"].tolist(), []
            for at in range(0, len(keys), batch):
                part = [w for w in wavs[at : at + batch] if w is not None]
                try:
                    got = iter(hear(part) if part else [])
                except Exception as e:  # noqa: BLE001
                    got = iter([e] * len(part))
                for k, w in zip(keys[at : at + batch], wavs[at : at + batch]):
                    r = ValueError("no audio") if w is None else next(got)
                    text, lid = (None, None) if isinstance(r, BaseException) else (r if isinstance(r, tuple) else (r, None))
                    out.append((k, model, text, lid, str(r)[:500] if isinstance(r, BaseException) else None))
            yield pd.DataFrame(out, columns=[key, "model", "text", "lid", "error"]).astype({"text": object, "lid": object, "error": object})

    return clips.select(key, "wav").mapInPandas(run, f"{key} {dict(clips.dtypes)[key]}, model string, text string, lid string, error string")


def mock_transcriber(said: dict[bytes, str] | None = None) -> Callable[[], Callable[[list[bytes]], list]]:
    """An offline transcriber: what ``said`` has for a clip, else its length in bytes as a text."""
    return lambda: lambda clips: [(said or {}).get(c, f"{len(c)} bytes") for c in clips]
