"""Model providers as table functions: a provider answers a task for rows of payloads.

``rules`` works without a model.  Answers can be kept in a table keyed by task, payload and provider; only payloads that
are not in it are asked (an anti-join).  Providers for remote models implement the same protocol and are not part of this
package.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specweave.session import checkpointed

#: The tasks a provider may be given.
TASKS = ("attribute_candidates", "entity_proposals", "entity_quality", "binding_judgement")


class Provider(Protocol):
    name: str

    def call(self, task: str, payload: dict[str, Any]) -> dict[str, Any]: ...


@dataclass(frozen=True)
class RulesProvider:
    """Deterministic answers: known names and aliases found in a text, no adjustments, bindings by a plain pattern.

    ``known``: name -> (type, aliases); names that the payload lists are known too.
    """

    known: tuple[tuple[str, str, tuple[str, ...]], ...] = ()
    name: str = "rules"

    def _entities(self, payload: dict[str, Any]) -> list[dict[str, Any]]:
        text, found = payload.get("source_text") or "", []
        listed = {n: ("", ()) for n in payload.get("known_entities") or []} | {n: (kind, more) for n, kind, more in self.known}
        for entity, (kind, more) in sorted(listed.items()):
            spellings = sorted((entity, *more), key=len, reverse=True)
            hits = (re.search(rf"(?<![\w-]){re.escape(s)}(?![\w-])", text, re.I) for s in spellings)
            first = next((h for h in hits if h), None)
            if first:
                found.append({"entity_name": entity, "entity_type": kind, "chunk_id": payload.get("chunk_id"), "evidence_quote": first.group()})
        return found

    def call(self, task: str, payload: dict[str, Any]) -> dict[str, Any]:
        if task == "entity_proposals":
            return {"entities": self._entities(payload)}
        if task == "entity_quality":
            return {"specificity_delta": 0.0, "real_world_delta": 0.0, "reason": ""}
        if task == "binding_judgement":
            text, entity, name = payload.get("source_text") or "", payload.get("entity") or "", payload.get("attribute") or ""
            near = [rf"{re.escape(x)}.{{0,80}}{re.escape(y)}" for x, y in ((entity, name), (name, entity))]
            return {"bound": bool(entity and name and re.search("|".join(near), text, re.I | re.S))}
        if task == "attribute_candidates":
            return {"candidates": []}
        raise ValueError(f"unknown task {task!r}")


@dataclass(frozen=True)
class ScriptedProvider:
    """Answers from a table of (task, payload as JSON) pairs; ``strict`` raises where there is none."""

    answers: dict[tuple[str, str], dict[str, Any]]
    name: str = "mock"
    strict: bool = False

    def call(self, task: str, payload: dict[str, Any]) -> dict[str, Any]:
        key = (task, json.dumps(payload, sort_keys=True))
        if self.strict and key not in self.answers:
            raise KeyError(f"no answer for {key}")
        return self.answers.get(key, {})


def provider(name: str, known: dict[str, Callable[[], Provider]] | None = None) -> Provider:
    """A provider by name; further ones can be registered by the caller."""
    makers: dict[str, Callable[[], Provider]] = {"rules": RulesProvider, "auto": RulesProvider, "mock": lambda: ScriptedProvider({})} | (known or {})
    if name not in makers:
        raise ValueError(f"unknown provider {name!r}")
    return makers[name]()


def cache_key(task: str, payload: Column, who: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(task), payload, F.lit(who)), 256)


def answered(requests: DataFrame, task: str, by: Provider | None, cache: DataFrame | None = None, store: str | None = None) -> DataFrame:
    """Requests (any keys and ``payload`` as JSON) with ``cache_key`` and ``answer`` as JSON; each different payload is
    asked once, and only if ``cache`` (cache_key, answer) doesn't have it.

    ``store``: a folder to which new answers are appended, to be the next run's cache.  Without a provider the cache is
    replayed: a payload that it doesn't have is an error.
    """
    who = by.name if by is not None else "replay"
    keyed = requests.withColumn("cache_key", cache_key(task, F.col("payload"), who))
    asked = keyed.select("cache_key", "payload").dropDuplicates(["cache_key"])
    if cache is not None:
        asked = asked.join(cache, "cache_key", "left_anti")
    if by is None:
        if cache is None or not asked.isEmpty():
            raise ValueError(f"{task}: the kept answers don't cover all requests")
        return keyed.join(cache.select("cache_key", "answer"), "cache_key", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"cache_key": pdf["cache_key"], "answer": [json.dumps(by.call(task, json.loads(p)), sort_keys=True) for p in pdf["payload"]]})

    answers = asked.mapInPandas(run, "cache_key string, answer string")
    if store is not None:
        answers = checkpointed(answers)  # asked once, written and used
        answers.write.mode("append").parquet(store)
    if cache is not None:
        answers = answers.unionByName(cache.select("cache_key", "answer"))
    return keyed.join(answers, "cache_key", "left")


def proposals(chunks: DataFrame, known: list[str], by: Provider, cache: DataFrame | None = None, store: str | None = None) -> DataFrame:
    """Entities that a provider proposes, as a source for entity generation; quotes that aren't in their chunk are dropped."""
    payload = F.to_json(F.struct("chunk_id", F.lit(sorted(known)).alias("known_entities"), "source_text"))
    rows = answered(chunks.select("document_id", "chunk_id", "source_text", payload.alias("payload")), "entity_proposals", by, cache, store)
    schema = "struct<entities:array<struct<entity_name:string,entity_type:string,chunk_id:string,evidence_quote:string>>>"
    p = rows.select("document_id", "chunk_id", "source_text", F.explode(F.from_json("answer", schema)["entities"]).alias("p")).filter("trim(p.entity_name) <> '' and p.chunk_id = chunk_id and p.evidence_quote <> '' and contains(source_text, p.evidence_quote)")
    return p.groupBy("document_id", F.trim("p.entity_name").alias("name")).agg(
        F.array().cast("array<string>").alias("attrs"), F.collect_set("chunk_id").alias("chunks"), F.collect_set(F.struct("chunk_id", F.col("p.evidence_quote").alias("text"))).alias("evidence")
    ).withColumn("origin", F.lit("llm"))


def adjustments(cents: DataFrame, by: Provider, cache: DataFrame | None = None, store: str | None = None) -> DataFrame:
    """document_id, canonical_id, specificity_delta, real_world_delta: what a provider thinks of canonical entities."""
    quotes = F.transform("supporting_evidence", lambda e: e["text"])
    payload = F.to_json(F.struct("canonical_name", "entity_type", quotes.alias("evidence")))
    rows = answered(cents.select("document_id", "canonical_id", payload.alias("payload")), "entity_quality", by, cache, store)
    said = F.from_json("answer", "struct<specificity_delta:double,real_world_delta:double>")
    return rows.select("document_id", "canonical_id", said["specificity_delta"].alias("specificity_delta"), said["real_world_delta"].alias("real_world_delta"))


def proposed_candidates(chunks: DataFrame, blocks: DataFrame, by: Provider, cache: DataFrame | None = None, store: str | None = None) -> DataFrame:
    """Attribute candidates that a provider proposes, in the form of ``operators.candidates``; each stands at the first
    block of its chunk that has the quote, and quotes that no block has are dropped."""
    payload = F.to_json(F.struct("chunk_id", "heading_path", "source_text"))
    rows = answered(chunks.select("document_id", "chunk_id", "block_ids", payload.alias("payload")), "attribute_candidates", by, cache, store)
    schema = "struct<candidates:array<struct<raw_name:string,source_text_quote:string,sentence:string>>>"
    said = rows.select("document_id", "chunk_id", "block_ids", F.posexplode(F.from_json("answer", schema)["candidates"]).alias("n", "c")).filter("trim(c.raw_name) <> '' and c.source_text_quote <> ''")
    at = said.select("document_id", "chunk_id", "n", "c", F.posexplode("block_ids").alias("pos", "block_id")).join(blocks.select("document_id", "block_id", "text"), ["document_id", "block_id"])
    held = at.filter(F.contains("text", F.col("c.source_text_quote"))).groupBy("document_id", "chunk_id", "n").agg(F.min_by(F.struct("pos", "block_id", "c"), "pos").alias("h"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    place = F.struct(F.lit(3).alias("emitter"), F.col("n").alias("a"), F.lit(0).alias("b"))
    return held.select(
        "document_id", "chunk_id", F.col("h.block_id").alias("block_id"), F.col("h.pos").alias("pos"), place.alias("place"), F.trim("h.c.raw_name").alias("raw_name"), F.lit("llm").alias("origin"), none.alias("cells"),
        F.coalesce("h.c.sentence", "h.c.source_text_quote").alias("sentence"),
    )
