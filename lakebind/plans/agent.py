"""Answering a question from retrieved context: a bounded loop over a provider, with steps kept for resuming.

The provider is an interface with a deterministic stand-in. Code that a model writes is never executed: the executor is
an argument, and the default one declines.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Provider(Protocol):
    def generate(self, prompt: str) -> str: ...


class FakeProvider:
    """Replies from a list, then the last one again."""

    def __init__(self, *replies: str):
        self.replies, self.prompts = list(replies), []

    def generate(self, prompt: str) -> str:
        self.prompts.append(prompt)
        return self.replies.pop(0) if len(self.replies) > 1 else self.replies[0]


def declined(code: str) -> tuple[bool, str]:
    return False, "execution is not enabled"


def route(reply: str, has_files: bool) -> str:
    """DIRECT or CODE, as the reply says; without a word of either, DIRECT only if there are no files."""
    match = re.search(r"\b(DIRECT|CODE)\b", reply or "", re.IGNORECASE)
    return match.group(1).upper() if match else ("CODE" if has_files else "DIRECT")


def final_answer(reply: str) -> str:
    for pattern in (r"<final_answer>(.*?)</final_answer>", r"FINAL_ANSWER:\s*(.*)$"):
        if match := re.search(pattern, reply, re.IGNORECASE | re.DOTALL):
            return match.group(1).strip()
    return reply.strip()


def code_of(reply: str) -> str:
    match = re.search(r"```(?:\w+)?\n(.*?)```", reply, re.DOTALL)
    return match.group(1) if match else reply


@dataclass
class Steps:
    """The steps of one run, a file each, so that a run can go on where it stopped."""

    folder: Path
    state: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.folder.mkdir(parents=True, exist_ok=True)
        path = self.folder / "state.json"
        if path.exists():
            self.state = json.loads(path.read_text())

    def once(self, name: str, make: Callable[[], str]) -> str:
        """The result of a step: kept from before, or made and kept."""
        if name not in self.state:
            self.state[name] = make()
            (self.folder / "state.json").write_text(json.dumps(self.state, ensure_ascii=False))
        return self.state[name]


def answer(question: str, context: str, files: list[str], provider: Provider, folder: str, rounds: int = 3, attempts: int = 2, execute: Callable[[str], tuple[bool, str]] = declined) -> str:
    """The final answer: directly from the context, or by plan, code, execution and verification in at most ``rounds`` rounds."""
    steps = Steps(Path(folder))
    if route(steps.once("route", lambda: provider.generate(f"DIRECT or CODE?\n{question}\n{context}")), bool(files)) == "DIRECT":
        raw = steps.once("direct", lambda: provider.generate(f"Answer.\n{question}\n{context}"))
    else:
        raw, plan = "", ""
        for turn in range(rounds):
            plan = steps.once(f"plan-{turn}", lambda: provider.generate(f"Plan.\n{question}\n{context}\n{plan}\n{raw}"))  # noqa: B023
            code = steps.once(f"code-{turn}", lambda: provider.generate(f"Code.\n{plan}"))  # noqa: B023
            for attempt in range(attempts):
                ran, raw = execute(code_of(code))
                if ran:
                    break
                code = steps.once(f"debug-{turn}-{attempt}", lambda: provider.generate(f"Repair.\n{code}\n{raw}"))  # noqa: B023
            if "yes" in steps.once(f"verify-{turn}", lambda: provider.generate(f"Is this enough?\n{question}\n{raw}")).lower():  # noqa: B023
                break
        raw = steps.once("final", lambda: provider.generate(f"Answer from the result.\n{question}\n{raw}"))
    return final_answer(raw)


def answer_all(questions: DataFrame, contexts: DataFrame, make: Callable[[], Provider], folder: str, budget: int = 60_000) -> DataFrame:
    """(question_id, answer, n_files): every question answered in a task from the contexts of its files.

    ``questions`` have question_id, question and source_files; ``contexts`` have source_path and context. Contexts are
    joined in the order of the files and cut at the budget of a question; the steps of each question are kept in a folder
    of its own, so that a task that runs again goes on where it stopped. A question that fails gets an empty answer.
    """
    listed = questions.select("question_id", "question", F.posexplode_outer("source_files").alias("at", "source_path")).join(contexts.select("source_path", "context"), "source_path", "left")
    whole = listed.groupBy("question_id", "question").agg(
        F.substring(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("source_path").isNotNull(), F.struct("at", F.coalesce("context", F.concat(F.lit("No context found for "), "source_path"))
        .alias("c"))))), lambda x: x["c"]), "\n\n"), 1, budget).alias("context"), F.array_sort(F.collect_set("source_path")).alias("files"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for number, question, context, files in batch.itertuples(index=False):
                safe = re.sub(r"[^A-Za-z0-9_-]+", "_", str(number)) + "-" + hashlib.sha1(str(number).encode()).hexdigest()[:8]
                try:
                    reply = answer(question or "", context or "", list(files), make(), f"{folder}/question_{safe}")
                except Exception:  # one question must not end the run of all
                    reply = ""
                out.append((number, reply, len(files)))
            yield pd.DataFrame(out, columns=["question_id", "answer", "n_files"])

    return whole.select("question_id", "question", "context", "files").mapInPandas(run, "question_id string, answer string, n_files int")


def remember(rows: DataFrame, path: str) -> None:
    """Appends (file, code, result) to the cache of what was learned of files, with the time."""
    rows.select("file", "code", "result", F.current_timestamp().alias("cached_at")).write.mode("append").parquet(path)


def recall(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of the cache for each file; an empty table if nothing was kept yet."""
    from lakebind.operators.chunking import latest_by_key

    try:
        log = spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], "file string, code string, result string, cached_at timestamp")
    return latest_by_key(log, "file", "cached_at")
