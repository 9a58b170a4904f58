"""Asking an external labeller, with a ledger of tries, so that a failure loses no other key and is tried again."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.schemas import LABEL_ATTEMPTS

#: Tries that a key gets, and keys that the labeller is handed at once.
MOST_TRIES = 5
LOT = 50

ANSWERED, SILENT, FAILED = "answered", "no answer", "failed"

#: Takes prompts, gives as many raw answers; None where it has none. It may raise.
Labeller = Callable[[Sequence[str]], Sequence[str | None]]


def last_attempts(attempts: DataFrame) -> DataFrame:
    """The latest row of each key."""
    last = attempts.groupBy("query").agg(F.max(F.struct("tries", "outcome", "label")).alias("last"))
    return last.select("query", "last.*")


def to_ask(open_keys: DataFrame, attempts: DataFrame, most_tries: int = MOST_TRIES) -> DataFrame:
    """(query, prompt, tries so far) of the keys without an answer that have tries left."""
    last = last_attempts(attempts)
    joined = open_keys.select("query", "prompt").distinct().join(last, "query", "left")
    left = F.col("outcome").isNull() | ((F.col("outcome") != ANSWERED) & (F.col("tries") < most_tries))
    return joined.where(left).select("query", "prompt", F.coalesce("tries", F.lit(0)).cast("bigint").alias("tries"))


def attempt_labels(
    open_keys: DataFrame, attempts: DataFrame, labeller: Labeller, most_tries: int = MOST_TRIES, lot: int = LOT
) -> DataFrame:
    """One more try for each key of ``to_ask``: rows to append to the ledger (query, tries, outcome, label).

    Keys are dealt to the labeller in lots. If it raises, or gives a wrong number of answers, the lot is halved, so in the end only
    the keys that it cannot label fail. ``label`` is the raw answer. To be written before it is read twice, as the labeller would be asked again.
    """

    def asked(prompts: list[str]) -> list[tuple[str, str | None]]:
        try:
            answers = list(labeller(prompts))
            if len(answers) == len(prompts):
                return [(SILENT if a is None else ANSWERED, a) for a in answers]
        except Exception:  # whatever the labeller raises is the outcome of its keys
            pass
        if len(prompts) == 1:
            return [(FAILED, None)]
        half = len(prompts) // 2
        return asked(prompts[:half]) + asked(prompts[half:])

    def attempt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), lot):
                some = frame.iloc[at : at + lot]
                outcomes = asked(some["prompt"].tolist())
                yield pd.DataFrame(
                    {
                        "query": some["query"].to_numpy(),
                        "tries": some["tries"].to_numpy() + 1,
                        "outcome": [outcome for outcome, _ in outcomes],
                        "label": pd.Series([label for _, label in outcomes], dtype=object),
                    }
                )

    return to_ask(open_keys, attempts, most_tries).mapInPandas(attempt, LABEL_ATTEMPTS)


def answers(attempts: DataFrame) -> DataFrame:
    """The ledger's answers as learned labels."""
    return attempts.where(F.col("outcome") == ANSWERED).select("query", "label")
