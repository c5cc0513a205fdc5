"""Apply a model to text columns on the executors.

A scorer is made once per task by a factory (that is where weights are loaded) and turns
a batch of texts into a frame of outputs. Only the text goes to Python, in Arrow batches;
all other columns stay with Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[pd.Series], pd.DataFrame]

# Outputs for blank text and for rows the model fails on.
POST_DEFAULTS = {"description_Normalized": "", "Label_NER": "O", "Label_Topic": "None", "Label_Intent": "Unknown"}
SENTIMENT_DEFAULT = "NEU"


def _guarded(score: Scorer, texts: pd.Series, defaults: dict[str, str], keep_text: str | None) -> pd.DataFrame:
    """Score a batch; if it fails, score row by row, give failing rows the defaults and mark them."""
    blank = texts.isna() | (texts.str.strip() == "")
    out = pd.DataFrame({k: pd.Series([v] * len(texts), index=texts.index, dtype=object) for k, v in defaults.items()})
    out["failed"] = False
    todo = texts[~blank]
    if todo.empty:
        return out
    columns = list(defaults)
    try:
        out.loc[todo.index, columns] = score(todo)[columns].to_numpy()
    except Exception:
        for i, text in todo.items():
            try:
                out.loc[i, columns] = score(pd.Series([text]))[columns].to_numpy()[0]
            except Exception:
                out.loc[i, "failed"] = True
                if keep_text:
                    out.loc[i, keep_text] = text
    return out


def score_text(
    df: DataFrame, text: str, factory: Callable[[], Scorer], defaults: dict[str, str], keep_text: str | None = None, failed: str | None = None
) -> DataFrame:
    """``df`` with one string column per entry of ``defaults``, and, under the name ``failed``, whether the model failed on the row."""
    schema = ", ".join([*(f"{k} string" for k in defaults), "failed boolean"])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = factory()
        for texts in batches:
            yield _guarded(score, texts.reset_index(drop=True), defaults, keep_text)

    scored = F.pandas_udf(run, schema)
    held = df.withColumn("__scored", scored(F.col(text)))
    marks = [F.col("__scored")["failed"].alias(failed)] if failed else []
    return held.select(*df.columns, *[F.col("__scored")[k].alias(k) for k in defaults], *marks)


def score_posts(df: DataFrame, text: str, factory: Callable[[], Scorer], failed: str | None = None) -> DataFrame:
    """Normalised text, tags, topics and intent; a failing row keeps its own text."""
    return score_text(df, text, factory, POST_DEFAULTS, "description_Normalized", failed)


def score_sentiment(df: DataFrame, text: str, factory: Callable[[], Scorer], failed: str | None = None) -> DataFrame:
    """POS, NEG or NEU per row; blank or failing rows are NEU."""
    return score_text(df, text, factory, {"sentiment": SENTIMENT_DEFAULT}, failed=failed)


def lexicon_scorer(positive: list[str], negative: list[str]) -> Callable[[], Scorer]:
    """A plug-in scorer: more words of one list than of the other decide the label."""

    def factory() -> Scorer:
        good, bad = frozenset(positive), frozenset(negative)

        def label(text: str) -> str:
            found = text.lower().split()
            balance = sum(w in good for w in found) - sum(w in bad for w in found)
            return "POS" if balance > 0 else "NEG" if balance < 0 else SENTIMENT_DEFAULT

        return lambda texts: pd.DataFrame({"sentiment": texts.map(label)})

    return factory


def shape_scorer(topics: dict[str, str], question: str = "ask", statement: str = "tell") -> Callable[[], Scorer]:
    """A plug-in scorer by word shape, for trying the post model's flow without weights.

    A capitalised word opens ORG and capitalised words after it go on; ``topics`` maps a
    word to a topic; a question mark anywhere makes the intent a question.
    """

    def factory() -> Scorer:
        def one(text: str) -> tuple[str, str, str, str]:
            tokens, tags, inside = text.split(), [], False
            for token in tokens:
                capital = "A" <= token[0] <= "Z"
                tags.append(("I-ORG" if inside else "B-ORG") if capital else "O")
                inside = capital
            present = set(tokens)
            found = [topic for word, topic in topics.items() if word in present]
            return " ".join(tokens), " ".join(tags), "|".join(found) or "None", question if "?" in text else statement

        return lambda texts: pd.DataFrame([one(t) for t in texts], columns=list(POST_DEFAULTS))

    return factory
