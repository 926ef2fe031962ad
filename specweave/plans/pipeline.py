"""The nine stages over a corpus, each written as Parquet and read again, with retries, resuming and counters.

A run's outputs lie under ``root/<fingerprint of settings and lexicon>/<nn_stage>/<table>``; a stage is done when its mark
exists, so a run that was cut off goes on with the first stage that isn't.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from specweave import config
from specweave.functions import providers
from specweave.operators import attributes as attribute_ops
from specweave.operators import chunking, cleaning, duplicates, entities, mapping, naming, outputs, quality
from specweave.sources.lexicons import Lexicon


class StageError(RuntimeError):
    """A stage's input is missing or its output is wrong."""


@dataclass
class Run:
    spark: SparkSession
    root: str
    settings: dict[str, Any]
    lexicon: Lexicon
    tables: dict[str, DataFrame] = field(default_factory=dict)
    records: list[dict[str, Any]] = field(default_factory=list)
    #: A model that proposes entities and candidates and judges entities; None (or the rules) proposes nothing.
    model: providers.Provider | None = None

    @property
    def home(self) -> str:
        return f"{self.root}/{config.fingerprint(self.settings, self.lexicon)}"


def _document_processing(run: Run) -> dict[str, DataFrame]:
    blocks = cleaning.mark_furniture(cleaning.with_table_subjects(run.tables["input_blocks"]), run.lexicon)
    return {"blocks": blocks, "titles": cleaning.titles(blocks)}


def _chunking(run: Run) -> dict[str, DataFrame]:
    c = run.settings["chunking"]
    blocks = run.tables["blocks"]
    if c["strategy"] == "by_page":
        return {"chunks": chunking.by_page(blocks, c["max_tokens"])}
    if c["strategy"] == "fixed_tokens":
        return {"chunks": chunking.fixed_tokens(blocks, c["max_tokens"], c["overlap_tokens"])}
    return {"chunks": chunking.heading_aware(blocks, c["max_tokens"], c["overlap_tokens"], c["heading_split_level"])}


def _attribute_extraction(run: Run) -> dict[str, DataFrame]:
    proposed = providers.proposed_candidates(run.tables["chunks"], run.tables["blocks"], run.model) if run.model else None
    return {"all_attributes": attribute_ops.extract(run.tables["chunks"], run.tables["blocks"], run.lexicon, run.tables["titles"], run.settings["scoring"], run.settings["binding"]["document_default_entity"], proposed)}


def _attribute_storage(run: Run) -> dict[str, DataFrame]:
    every = run.tables["all_attributes"]
    kept = attribute_ops.dedup(every)
    return {"attributes": kept, "discarded": every.filter("score.route = 'discard'"), "attribute_reviews": attribute_ops.review_items(kept)}


def _entity_generation(run: Run) -> dict[str, DataFrame]:
    proposed = providers.proposals(run.tables["chunks"], list(run.lexicon.known), run.model) if run.model else None
    return {"entities": entities.generate(run.tables["attributes"], run.tables["discarded"], run.tables["chunks"], run.lexicon, proposed)}


def _entity_normalization(run: Run) -> dict[str, DataFrame]:
    return {"named_entities": naming.normalized(run.tables["entities"], aliases=run.lexicon.aliases)}


def _entity_reviewer(run: Run) -> dict[str, DataFrame]:
    e = run.tables["named_entities"]
    pairs = duplicates.checkpointed(duplicates.duplicate_pairs(e, run.lexicon))
    cents = duplicates.checkpointed(duplicates.canonical_entities(e, duplicates.groups(e, pairs)))
    decisions = duplicates.checkpointed(quality.decide(cents, run.tables["chunks"], run.tables["attributes"], run.lexicon, providers.adjustments(cents, run.model) if run.model else None))
    return {"duplicate_pairs": pairs, "canonical_entities": cents, "decisions": decisions, "entity_reviews": duplicates.review_items(pairs).unionByName(quality.review_items(decisions))}


def _attribute_mapping(run: Run) -> dict[str, DataFrame]:
    t = run.tables
    rows = duplicates.checkpointed(mapping.judged(t["attributes"], t["entities"], t["canonical_entities"], t["decisions"], t["chunks"], run.lexicon, run.settings["mapping"]["include_review_entities"]))
    return {"mappings": mapping.mappings(rows), "unmapped": mapping.unmapped(rows)}


def _final_output(run: Run) -> dict[str, DataFrame]:
    t = run.tables
    edges = outputs.trace_edges(t["chunks"], t["attributes"], t["entities"], t["canonical_entities"], t["mappings"])
    summaries = outputs.summaries(t["blocks"], cleaning.pages_of(t["blocks"]), t["chunks"])
    dangling = t["attributes"].filter("entity is null").select("document_id", "attribute_id")
    queue = t["attribute_reviews"].unionByName(t["entity_reviews"])
    review = outputs.review_section(t["canonical_entities"], t["decisions"])
    parts = {
        "document": summaries, "attributes": t["attributes"].drop("cand"), "entities": t["canonical_entities"], "mappings": t["mappings"], "review": review, "review_queue": queue,
        "unmapped": t["unmapped"], "dangling": dangling, "trace": edges,
    }
    form = run.settings["output"]["graph_export"]
    graph = outputs.documents_graph(edges, form) if form else run.spark.createDataFrame([], "document_id string, seq bigint, text string")
    return {"trace_edges": edges, "graph_nodes": outputs.nodes(edges), "review": review, "dangling": dangling, "final": outputs.documents_json(parts), "graph": graph}


# -- what each stage's output must fulfil: tables of problems that must be empty


def _chunk_problems(run: Run) -> DataFrame:
    return chunking.chunk_problems(run.tables["chunks"], run.tables["blocks"])


def _attribute_problems(run: Run) -> DataFrame:
    return attribute_ops.problems(run.tables["all_attributes"], run.tables["chunks"]).select("document_id", F.concat_ws(": ", "problem", "attribute_id").alias("problem"))


def _entity_problems(run: Run) -> DataFrame:
    t = run.tables
    found = entities.problems(t["entities"], t["chunks"]).select("document_id", F.concat_ws(": ", "problem", "entity_id").alias("problem"))
    twice = t["entities"].groupBy("document_id", "entity_id").count().filter("count > 1").select("document_id", F.concat(F.lit("twice: "), "entity_id").alias("problem"))
    return found.unionByName(twice)


def _review_problems(run: Run) -> DataFrame:
    return duplicates.partition_problems(run.tables["named_entities"], run.tables["canonical_entities"], run.tables["decisions"])


def _mapping_problems(run: Run) -> DataFrame:
    return mapping.problems(run.tables["mappings"], run.tables["attributes"], run.tables["canonical_entities"])


def _trace_problems(run: Run) -> DataFrame:
    t = run.tables
    return outputs.trace_problems(t["trace_edges"], outputs.known_ids(t["chunks"], t["attributes"], t["entities"], t["canonical_entities"], t["mappings"]))


CHECKS: dict[str, Callable[[Run], DataFrame]] = {
    "chunking": _chunk_problems, "attribute_extraction": _attribute_problems, "entity_generation": _entity_problems,
    "entity_reviewer": _review_problems, "attribute_mapping": _mapping_problems, "final_output": _trace_problems,
}


@dataclass(frozen=True)
class Stage:
    name: str
    work: Callable[[Run], dict[str, DataFrame]]
    needs: tuple[str, ...]
    makes: tuple[str, ...]


STAGES = (
    Stage("document_processing", _document_processing, ("input_blocks",), ("blocks", "titles")),
    Stage("chunking", _chunking, ("blocks",), ("chunks",)),
    Stage("attribute_extraction", _attribute_extraction, ("chunks", "blocks", "titles"), ("all_attributes",)),
    Stage("attribute_storage", _attribute_storage, ("all_attributes",), ("attributes", "discarded", "attribute_reviews")),
    Stage("entity_generation", _entity_generation, ("attributes", "discarded", "chunks"), ("entities",)),
    Stage("entity_normalization", _entity_normalization, ("entities",), ("named_entities",)),
    Stage("entity_reviewer", _entity_reviewer, ("named_entities", "chunks", "attributes"), ("duplicate_pairs", "canonical_entities", "decisions", "entity_reviews")),
    Stage("attribute_mapping", _attribute_mapping, ("attributes", "entities", "canonical_entities", "decisions", "chunks"), ("mappings", "unmapped")),
    Stage(
        "final_output", _final_output, ("blocks", "chunks", "attributes", "attribute_reviews", "entities", "canonical_entities", "decisions", "entity_reviews", "mappings", "unmapped"),
        ("trace_edges", "graph_nodes", "review", "dangling", "final", "graph"),
    ),
)


def _folder(run: Run, i: int, stage: Stage) -> str:
    return f"{run.home}/{i + 1:02d}_{stage.name}"


def _exists(run: Run, path: str) -> bool:
    place = run.spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(run.spark._jsc.hadoopConfiguration()).exists(place))


def _read(run: Run, i: int, stage: Stage) -> None:
    for name in stage.makes:
        run.tables[name] = run.spark.read.parquet(f"{_folder(run, i, stage)}/{name}")


def _perform(run: Run, i: int, stage: Stage) -> None:
    """One stage: inputs checked, work written and read again; failures of Spark are tried again, wrong inputs aren't."""
    missing = [n for n in stage.needs if n not in run.tables]
    if missing:
        raise StageError(f"{stage.name}: missing {', '.join(missing)}")
    retry, began = run.settings["retry"], time.time()
    for attempt in range(1, retry["max_attempts"] + 1):
        try:
            made = stage.work(run)
            if set(made) != set(stage.makes):
                raise StageError(f"{stage.name}: made {sorted(made)}, not {sorted(stage.makes)}")
            counts: dict[str, int] = {}
            for name, rows in made.items():
                seen = Observation()
                rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{_folder(run, i, stage)}/{name}")
                counts[name] = seen.get["n"]
            break
        except PySparkException as failure:
            if attempt == retry["max_attempts"] or "AnalysisException" in type(failure).__name__:
                raise StageError(f"{stage.name}: {str(failure)[:300]}") from failure
            time.sleep(retry["backoff_seconds"] * 2 ** (attempt - 1))
    _read(run, i, stage)
    if stage.name in CHECKS:
        wrong = CHECKS[stage.name](run).limit(5).collect()  # a few examples
        if wrong:
            raise StageError(f"{stage.name}: wrong output, e.g. " + "; ".join(f"{r.document_id}: {r.problem}" for r in wrong))
    run.records.append({"stage": stage.name, "attempts": attempt, "seconds": round(time.time() - began, 3), "rows": counts})
    run.spark.createDataFrame([(json.dumps(run.records[-1]),)], "record string").coalesce(1).write.mode("overwrite").text(f"{_folder(run, i, stage)}/_done")


def run_pipeline(blocks: DataFrame, root: str, settings: dict[str, Any] | None = None, lexicon: Lexicon | None = None, resume: bool = True, resume_from: str | None = None, overrides: dict[str, Callable[[Run], dict[str, DataFrame]]] | None = None, model: providers.Provider | None = None) -> Run:
    """Run all stages over ``blocks``.  ``resume`` takes finished stages as they are; ``resume_from`` works again from a
    stage on, whose predecessors must be finished; ``overrides`` replaces the work of stages by name; ``model`` may add to what the
    rules find."""
    run = Run(blocks.sparkSession, root, settings or config.load(), lexicon or Lexicon(), {"input_blocks": blocks}, model=model)
    names = [s.name for s in STAGES]
    if resume_from is not None and resume_from not in names:
        raise StageError(f"unknown stage {resume_from!r}")
    start = names.index(resume_from) if resume_from else None
    if start:
        undone = [s.name for i, s in enumerate(STAGES[:start]) if not _exists(run, f"{_folder(run, i, s)}/_done")]
        if undone:
            raise StageError(f"can't resume from {resume_from}: {', '.join(undone)} not finished")
    fresh = False
    for i, stage in enumerate(STAGES):
        done = _exists(run, f"{_folder(run, i, stage)}/_done")
        if done and not fresh and (i < start if start is not None else resume):
            _read(run, i, stage)
            run.records.append({"stage": stage.name, "resumed": True})
            continue
        fresh = True
        work = (overrides or {}).get(stage.name)
        _perform(run, i, Stage(stage.name, work, stage.needs, stage.makes) if work else stage)
    return run
