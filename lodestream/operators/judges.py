"""Hooks for external judges and summarisers, and what happens to their answers."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.functions.text import apply_aliases
from lodestream.plans.storage import materialize

#: How often a judge is asked again for rows it left out, and how many entities and facts a summary has.
ROUNDS, ENTITIES, FACTS = 3, 12, 20


def first_json(text: str | None) -> str | None:
    """The first JSON value in an answer: the whole, a fenced block, or from the first bracket to its last partner."""
    s = (text or "").strip()
    tries = [s, *(m.strip() for m in re.findall(r"```(?:json)?[ \t]*\r?\n(.*?)```", s, re.S))]
    opened = re.search(r"[{\[]", s)
    if opened:
        end = s.rfind("}" if opened[0] == "{" else "]")
        tries.append(s[opened.start() : end + 1])
    for t in tries:
        try:
            return json.dumps(json.loads(t), ensure_ascii=False)
        except ValueError:
            continue
    return None


@F.pandas_udf(T.StringType())
def extract_json(s: pd.Series) -> pd.Series:
    return s.map(first_json)


def ask(rows: DataFrame, key: str, judge: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch: int = 24, rounds: int = ROUNDS) -> DataFrame:
    """Answers of a judge that takes batches of rows and may leave some out; those are asked again, rounds times in all.

    judge gets at most ``batch`` rows and returns rows of schema, which has the key. Answers to unknown keys are left
    out; of several answers to a key one stays. Each round ends in tables: answers and rows left refer to each other,
    and a plan that holds both doubles with every round.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), batch):
                yield judge(part.iloc[at : at + batch])

    found, left = None, rows
    for _ in range(rounds):
        said = materialize(left.mapInPandas(run, schema))
        got = materialize(said.join(left.select(key).distinct(), key, "left_semi").dropDuplicates([key]))
        found = got if found is None else found.unionByName(got)
        left = materialize(left.join(got.select(key), key, "left_anti"))
        if left.isEmpty():
            break
    return found


def summary_row(title: Column, body: Column, said_title: Column, said: Column, entities: Column, facts: Column, aliases: dict[str, list[str]]) -> dict[str, Column]:
    """A summariser's answer in contract form, with a fallback from the item; names by their aliases, facts as they are."""
    blank = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    none = F.array().cast("array<string>")
    listed = lambda c, n: F.slice(F.filter(F.transform(F.coalesce(c, none), lambda x: F.trim(x)), lambda x: x != ""), 1, n)
    named = apply_aliases(F.array_join(listed(entities, ENTITIES), "\u0000"), aliases)
    return {
        "title_zh": apply_aliases(F.coalesce(blank(said_title), F.substring(F.coalesce(blank(title), F.lit("(untitled)")), 1, 30)), aliases),
        "summary": apply_aliases(F.coalesce(blank(said), F.substring(F.coalesce(blank(body), title, F.lit("")), 1, 120)), aliases),
        "entities": F.array_distinct(F.filter(F.split(named, "\u0000"), lambda x: x != "")), "facts": listed(facts, FACTS),
    }


def unknown_entities(summaries: DataFrame, names: DataFrame) -> DataFrame:
    """entity, n of the summaries' entities that no alias table names, the most frequent first."""
    seen = summaries.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n"))
    return seen.join(names.select(F.col("name").alias("entity")).distinct(), "entity", "left_anti").orderBy(F.desc("n"), "entity")


def embed(rows: DataFrame, key: str, text: str, embedder: Callable[[list[str]], np.ndarray], query: bool = False, instruction: str = "", batch: int = 64) -> DataFrame:
    """key, vector: what an external embedder makes of each text, at unit length; queries carry an instruction before them.

    embedder takes at most ``batch`` texts and returns a row of numbers for each; a null text counts as empty.
    """
    asked = F.concat(F.lit(f"{instruction} "), F.coalesce(text, F.lit(""))) if query else F.coalesce(text, F.lit(""))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), batch):
                some = part.iloc[at : at + batch]
                v = np.asarray(embedder(some["_t"].tolist()), float)
                v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
                yield pd.DataFrame({key: some[key], "vector": list(v)})

    kind = dict(rows.dtypes)[key]
    return rows.select(key, asked.alias("_t")).mapInPandas(run, f"{key} {kind}, vector array<double>")


def cached_summaries(summaries: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Stored summary records with today's aliases: names in titles, texts and entities, each entity once."""
    named = apply_aliases(F.array_join(F.coalesce("entities", F.array().cast("array<string>")), "\u0000"), aliases)
    return summaries.withColumns({
        "title_zh": apply_aliases(F.col("title_zh"), aliases), "summary": apply_aliases(F.col("summary"), aliases),
        "entities": F.array_distinct(F.filter(F.split(named, "\u0000"), lambda x: x != "")),
    })
