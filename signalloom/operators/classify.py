"""Domain labels with tiered confidence."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions import vocabulary as v
from signalloom.functions.extract import enrichment
from signalloom.functions.lexicon import mentions, tags_of_folded
from signalloom.functions.text import fold

#: From titles and bodies to an answer each: a dict, or JSON text, with labels and perhaps confidence and reasoning.
Scorer = Callable[[list[str], list[str]], list]


def item_text() -> Column:
    return F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body_text", F.lit("")))


#: Title and body of an item, folded.
FOLDED = "_folded"


def with_folded(items: DataFrame) -> DataFrame:
    """items with their folded text, worked out once for all that looks for words in it, as it is the dearest part: a generator of one row, which the optimizer doesn't copy into the filters and columns that use it."""
    return items if FOLDED in items.columns else items.select("*", F.explode(F.array(fold(item_text()))).alias(FOLDED))


def with_keyword_labels(items: DataFrame, lexicon: dict[str, list[str]] = v.DOMAINS) -> DataFrame:
    """items with keyword_labels, worked out once, by a generator too."""
    rows = with_folded(items).select("*", F.explode(F.array(tags_of_folded(F.col(FOLDED), lexicon))).alias("keyword_labels"))
    return rows.select(*items.columns, "keyword_labels")


def classify(items: DataFrame, lexicon: dict[str, list[str]] = v.DOMAINS, predictions: DataFrame | None = None) -> DataFrame:
    """items (item_id, title, body_text) with labels, confidence and classifier_reasoning.

    Two keyword labels or more decide. Otherwise a prediction (item_id, model_labels, model_confidence, model_reasoning), if there is
    one, comes first and keyword labels are added; a predicted label outside the lexicon is dropped. Without one, the
    keyword label stays with less confidence, and an item without any is unclassified.
    """
    rows = with_keyword_labels(items, lexicon)
    if predictions is None:
        nothing = {"model_labels": "array<string>", "model_confidence": "double", "model_reasoning": "string"}
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    else:
        rows = rows.join(predictions.select("item_id", "model_labels", "model_confidence", "model_reasoning"), "item_id", "left")
    return _decided(rows, lexicon)


def classify_with_scorer(items: DataFrame, make: Callable[[], Scorer], lexicon: dict[str, list[str]] = v.DOMAINS, most: int | None = 800) -> DataFrame:
    """The same with a scorer that may fail, and scorer_error: why it had no answer for an item, null where it had one or wasn't asked.

    make() gives the scorer, once for each task: from titles and bodies (their first `most` characters; None: whole) to an answer each, a dict or JSON text with labels, and perhaps confidence
    and reasoning. Only items with fewer than two keyword labels are asked for. If it raises for several items it is asked for each half of them, so an item that it can't
    take, or that it answers with something else, falls back to its keyword label alone and leaves the others as they are; so do all items of a task in which it can't be made.
    """
    rows = with_keyword_labels(items, lexicon)
    ask = F.size("keyword_labels") < 2
    body = F.coalesce("body_text", F.lit(""))
    asked = F.struct(ask.alias("ask"), F.when(ask, F.coalesce("title", F.lit(""))).alias("title"), F.when(ask, body if most is None else F.substring(body, 1, most)).alias("body"))

    @F.pandas_udf("model_labels array<string>, model_confidence double, model_reasoning string, scorer_error string")
    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, broken = None, None
        try:
            scorer = make()
        except Exception as e:  # noqa: BLE001  whatever the scorer raises
            broken = f"{type(e).__name__}: {e}"
        for batch in batches:
            todo = [*zip(batch["title"][batch["ask"]], batch["body"][batch["ask"]])]
            found = iter([(None, None, None, broken)] * len(todo) if scorer is None else answered(scorer, todo))
            yield pd.DataFrame([next(found) if ask else (None, None, None, None) for ask in batch["ask"]], columns=["model_labels", "model_confidence", "model_reasoning", "scorer_error"])

    rows = rows.withColumn("_answer", answers(asked))
    rows = rows.select(*items.columns, "keyword_labels", "_answer.*")
    decided = _decided(rows, lexicon)
    failed = F.col("scorer_error").isNotNull()
    return decided.withColumn("classifier_reasoning", F.when(failed, F.concat("classifier_reasoning", F.lit(" (no answer: "), "scorer_error", F.lit(")"))).otherwise(F.col("classifier_reasoning")))


def answered(scorer: Scorer, todo: list[tuple[str, str]]) -> list[tuple]:
    """(labels, confidence, reasoning, error) for each title and body. Where the scorer raises, halves are asked for, down to single items."""
    if not todo:
        return []
    try:
        found = list(scorer([t for t, _ in todo], [b for _, b in todo]))
        if len(found) != len(todo):
            raise ValueError(f"{len(found)} answers for {len(todo)} items")
    except Exception as e:  # noqa: BLE001  whatever the scorer raises
        if len(todo) == 1:
            return [(None, None, None, f"{type(e).__name__}: {e}")]
        half = len(todo) // 2
        return answered(scorer, todo[:half]) + answered(scorer, todo[half:])
    return [*map(understood, found)]


def understood(answer: dict | str) -> tuple:
    """An answer's labels, confidence, reasoning, and why it can't be understood, if so."""
    try:
        said = json.loads(answer) if isinstance(answer, str) else answer
        labels, confidence = said.get("labels") or [], said.get("confidence")
        return [x for x in labels if isinstance(x, str)], None if confidence is None else float(confidence), str(said.get("reasoning", "")), None
    except (ValueError, TypeError, AttributeError) as e:
        return None, None, None, f"{type(e).__name__}: {e}"


def _decided(rows: DataFrame, lexicon: dict[str, list[str]]) -> DataFrame:
    """rows with keyword labels and a model's answer (null where there is none) with labels, confidence and classifier_reasoning instead."""
    known = F.array(*map(F.lit, [*lexicon, v.UNCLASSIFIED]))
    model = F.array_intersect("model_labels", known)
    model = F.when(F.size(model) > 0, model).otherwise(F.array(F.lit(v.UNCLASSIFIED)))
    n, modelled = F.size("keyword_labels"), F.col("model_labels").isNotNull()
    labels = F.when(n >= 2, F.col("keyword_labels")).when(modelled, F.array_union(model, "keyword_labels")).when(n == 1, F.col("keyword_labels")).otherwise(F.array(F.lit(v.UNCLASSIFIED)))
    confidence = F.when(n >= 2, v.SEVERAL_LABELS).when(modelled, F.coalesce("model_confidence", F.lit(v.MODEL_DEFAULT))).when(n == 1, v.ONE_LABEL).otherwise(v.NO_LABEL)
    reason = F.when(n >= 2, "several keyword labels").when(modelled, F.coalesce("model_reasoning", F.lit(""))).when(n == 1, "keyword label alone").otherwise("no label")
    return rows.withColumns({"labels": labels, "confidence": confidence, "classifier_reasoning": reason}).drop("keyword_labels", "model_labels", "model_confidence", "model_reasoning")


def enrich(items: DataFrame) -> DataFrame:
    """items (title, body_text, source_name) with amounts, agencies, recipients, stage and beat."""
    rows = with_folded(items).withColumns(enrichment(F.col("title"), F.col("body_text"), F.col("source_name"), F.col(FOLDED)))
    return rows if FOLDED in items.columns else rows.drop(FOLDED)


def with_flags(items: DataFrame, urgent: list[str] = v.URGENT, water: dict[str, list[str]] = v.WATER_TAGS) -> DataFrame:
    """items with is_critical and domain_tags."""
    rows = with_folded(items).withColumns({"is_critical": mentions(F.col(FOLDED), urgent), "domain_tags": tags_of_folded(F.col(FOLDED), water)})
    return rows if FOLDED in items.columns else rows.drop(FOLDED)


def described(items: DataFrame, lexicon: dict[str, list[str]] = v.DOMAINS, predictions: DataFrame | None = None, urgent: list[str] = v.URGENT, water: dict[str, list[str]] = v.WATER_TAGS) -> DataFrame:
    """items classified, enriched and flagged; each text is folded once for all of it."""
    return with_flags(enrich(classify(with_folded(items), lexicon, predictions)), urgent, water).drop(FOLDED)
