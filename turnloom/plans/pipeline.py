"""The correction pipeline over many meetings at once, in stages that start from the tables of earlier ones.

Each stage reads tables, declares one plan and writes tables under ``work``; model calls aren't deterministic, so every
result of a judge is written before it is read again. A meeting is a value of a column, not a run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.inference import Load, judged, last_try
from turnloom.operators import hyps, passes, prompts, reports, textgrid, units, validators
from turnloom.plans import queries as q
from turnloom.session import checkpointed
from turnloom.sources.meetings import replace_audits

#: Stages in order, with the tables each needs.
STAGES: dict[str, tuple[str, ...]] = {"asr": (), "pass_a": ("hyps", "units"), "pass_b": ("hyps", "units", "draft"), "polish": ("hyps", "units", "final"), "stats": ("audits",)}
#: Names for several stages.
GROUPS: dict[str, tuple[str, ...]] = {"all": tuple(STAGES), "llm": ("pass_a", "pass_b")}


@dataclass(frozen=True)
class Judge:
    """A model for all passes: how it is loaded, how often it is asked again, and the one that is heard after it."""

    load: Load
    name: str = "judge"
    backend: str = "http"
    retries: int = 1
    batch: int = 64
    fallback: Judge | None = None

    def ask(self, jobs: DataFrame, key: str, invalid: Callable[[Column], Column], work: str, name: str) -> DataFrame:
        """(key, tries) for jobs (key, prompt)."""
        return judged(jobs, key, self.load, invalid, work, self.retries, self.name, self.backend, name, self.batch)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def require(spark: SparkSession, work: str, names: tuple[str, ...]) -> None:
    """Fail with FileNotFoundError where an earlier stage hasn't written what this one needs."""
    for n in names:
        if not _exists(spark, f"{work}/{n}"):
            raise FileNotFoundError(f"{work}/{n} is missing; run the stages before this one")


def merge_stats(old: DataFrame, new: DataFrame, key: str = "name") -> DataFrame:
    """Statistics by name, the new ones winning."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def _with_text(grid: DataFrame, texts: DataFrame, status: str) -> DataFrame:
    """The grid with new texts where there are any, and the status a text gives."""
    out = grid.drop("text", "asr_status").join(texts, "turn_id", "left").withColumn("text", F.coalesce("text", F.lit("")))
    return out.withColumn("asr_status", F.when(F.col("text") != "", status).otherwise("empty"))


def asr(spark: SparkSession, tables: str, work: str, judge: Judge | None = None) -> None:
    """Units and hypotheses: stored units are used again, meetings without any get them built from their turns; moss is filled from the turns where it is missing."""
    columns = ["unit_key", "meeting_id", "unit_id", "turn_indices", "overlap_ratio", "contains_overlap", "heavy_overlap", "skip_asr", "skip_reason"]
    stored = q.current_units(spark, tables, columns[1:]).select(*columns)
    turns = q.valid_turns(spark, tables)
    new = q.build_with_overlap(turns.join(stored.select("meeting_id").distinct(), "meeting_id", "left_anti"))
    stored.unionByName(new.select(*columns)).write.mode("overwrite").parquet(f"{work}/units")
    t = q.current_turns(spark, tables, ["meeting_id", "turn_index", "start_s", "end_s"])
    t.withColumn("reason", units.invalid_reason(F.col("start_s"), F.col("end_s"))).where("reason is not null").select("meeting_id", "turn_index", "reason").write.mode("overwrite").parquet(f"{work}/skipped_invalid")
    u = spark.read.parquet(f"{work}/units")
    filled = hyps.fill_moss(u, q.current_hyps(spark, tables), textgrid.members(u, q._grid_turns(spark, tables)))
    filled.write.mode("overwrite").parquet(f"{work}/hyps")


def pass_a(spark: SparkSession, tables: str, work: str, replies: DataFrame | None = None, fallback: DataFrame | None = None, judge: Judge | None = None) -> None:
    """Decided unit texts, cut back to a draft of every turn; of several units that hold a turn the last writes it."""
    u = spark.read.parquet(f"{work}/units")
    h = hyps.by_unit(spark.read.parquet(f"{work}/hyps")).join(u.where(~F.col("skip_asr")), "unit_key")
    if judge is not None:
        h = checkpointed(h)
        jobs = q.asked_units(h, q.neighbor_prompt(spark, tables), q.hotword_load(spark, tables))
        replies = judge.ask(jobs, "unit_key", validators.pass_a_error, work, "A")
        if judge.fallback is not None:
            still = jobs.join(replies.where(~F.exists("tries", lambda r: r.isNotNull() & validators.pass_a_error(r).isNull())).select("unit_key"), "unit_key", "left_semi")
            fallback = last_try(judge.fallback.ask(still, "unit_key", validators.pass_a_error, work, "A_fallback"), "unit_key", validators.pass_a_error)
    decided = passes.unit_texts(h, replies, fallback)
    decided.write.mode("overwrite").parquet(f"{work}/units_a")
    decided = spark.read.parquet(f"{work}/units_a")
    members = textgrid.members(u, q._grid_turns(spark, tables))
    cut = hyps.to_turns(decided.select("unit_key", F.lit("unit").alias("model"), "text"), members).join(u.select("unit_key", "meeting_id"), "unit_key")
    last = cut.groupBy("meeting_id", "turn_index").agg(F.max_by("text", "unit_key").alias("new"))
    grid = q._grid_turns(spark, tables)
    texts = grid.select("turn_id", "meeting_id", "turn_index", "text").join(last, ["meeting_id", "turn_index"], "left").select("turn_id", F.coalesce("new", "text").alias("text"))
    _with_text(grid, texts, "provisional").write.mode("overwrite").parquet(f"{work}/draft")
    path = F.when(F.col("skipped_llm"), "cer0_agree").when(F.col("fallback"), "fallback").when(F.col("forced_moss"), "forced_moss").otherwise("judged")
    replace_audits(decided.select(F.lit("A").alias("pass"), path.alias("path"), "unit_key", "retries", "fallback_ok", "last_error"), f"{work}/audits")


def pass_b(spark: SparkSession, tables: str, work: str, replies: Callable[[Column, Column], Column] | DataFrame = passes.mock_reply, judge: Judge | None = None) -> None:
    """Aliases put right, then the second pass over the draft."""
    draft = spark.read.parquet(f"{work}/draft")
    aliased = passes.rewrite_aliases(draft.select("turn_id", "text"), passes.parse_aliases(q.hotword_load(spark, tables)))
    rows = q._pass_b_turns(spark, tables, "turn_index", unit_rows=spark.read.parquet(f"{work}/units"), said=spark.read.parquet(f"{work}/hyps"))
    rows = rows.drop("text").join(aliased.select("turn_id", F.col("new_text").alias("text"), "hits"), "turn_id")
    second = None
    if judge is not None:
        rows = checkpointed(rows)
        jobs = turn_prompts(rows, q.hotword_load(spark, tables))
        tries = judge.ask(jobs, "turn_id", validators.pass_b_error, work, "B")
        replies = last_try(tries, "turn_id", validators.pass_b_error)
        if judge.fallback is not None:
            still = jobs.join(replies.where(F.col("reply").isNull() | validators.pass_b_error(F.col("reply")).isNotNull()).select("turn_id"), "turn_id", "left_semi")
            second = last_try(judge.fallback.ask(still, "turn_id", validators.pass_b_error, work, "B_fallback"), "turn_id", validators.pass_b_error)
    done = passes.turn_texts(rows, replies, fallback=second)
    done.write.mode("overwrite").parquet(f"{work}/turns_b")
    done = spark.read.parquet(f"{work}/turns_b")
    _with_text(draft, done.select("turn_id", F.col("new_text").alias("text")), "final").write.mode("overwrite").parquet(f"{work}/final")
    none = F.lit(None).cast("string")
    alias = done.select("turn_id", F.explode("hits").alias("h")).select("turn_id", F.lit("hotword_alias").alias("path"), F.col("h.alt").alias("span_asr"), F.col("h.canon").alias("span_out"), none.alias("tier"), F.lit("hotword").alias("anchor"), F.lit(False).alias("fallback_ok"))
    replace_audits(alias.unionByName(passes.turn_audits(done)).withColumn("pass", F.lit("B")), f"{work}/audits")


def turn_prompts(rows: DataFrame, terms: DataFrame, short_ms: int = 350) -> DataFrame:
    """(turn_id, prompt): what a judge of the second pass is asked about each turn with text that is long enough."""
    said = rows.select(F.col("turn_id").alias("unit_key"), passes._turn_hyps(F.col("text"), F.col("moss")).alias("hyps"))
    grid = rows.select(F.col("turn_id").alias("unit_key"), "meeting_id", F.lpad(F.col("turn_index").cast("string"), 12, "0").alias("unit_id"), "text", "dur_ms", "overlap")
    c = passes.with_citations(grid, said, terms).where((F.col("text") != "") & (F.col("dur_ms") >= short_ms))
    return c.select(F.col("unit_key").alias("turn_id"), prompts.judge_prompt(F.col("hyps"), F.col("cite_hotwords"), F.col("cite_neighbors"), F.col("overlap"), F.col("overlap")).alias("prompt"))


def polish(spark: SparkSession, tables: str, work: str, replies: Callable[..., Column] | DataFrame = passes.mock_polish, judge: Judge | None = None) -> None:
    """The merged grid of the final texts, polished; a judge of four columns also gets hypotheses, neighbours and hotwords."""
    stored = spark.read.parquet(f"{work}/units") if _exists(spark, f"{work}/units") else q.current_units(spark, tables, ["meeting_id", "unit_id", "turn_indices"])
    grid = textgrid.merged_grid(stored, spark.read.parquet(f"{work}/final"))
    rows = q._cited(spark, tables, grid, spark.read.parquet(f"{work}/hyps"), stored)
    if judge is not None:
        rows = checkpointed(rows)
        jobs = rows.where(F.col("text") != "").select("unit_key", prompts.polish_prompt(F.col("unit_id"), F.col("text"), F.col("hyps"), F.col("cite_hotwords"), F.col("cite_neighbors")).alias("prompt"))
        replies = last_try(judge.ask(jobs, "unit_key", lambda r: validators.judgment_shape(r), work, "polish"), "unit_key", lambda r: validators.judgment_shape(r))
    done = passes.polish_texts(rows, replies)
    done.select("unit_key", F.col("new_text").alias("text"), "path", "located").write.mode("overwrite").parquet(f"{work}/polished")
    done = spark.read.parquet(f"{work}/polished")
    replace_audits(passes.polish_audits(done).withColumn("pass", F.lit("polish")), f"{work}/audits")


def stats(spark: SparkSession, tables: str, work: str, judge: Judge | None = None) -> None:
    """(pass, path, n) over all audits; passes without audits keep the counts they had."""
    new = checkpointed(reports.histogram(spark.read.json(f"{work}/audits"), "path", "pass"))
    if _exists(spark, f"{work}/stats"):
        new = checkpointed(merge_stats(spark.read.parquet(f"{work}/stats"), new, "pass"))
    new.write.mode("overwrite").parquet(f"{work}/stats")


def run(spark: SparkSession, tables: str, work: str, stage: str = "all", judge: Judge | None = None) -> list[str]:
    """Run one stage or a group of them; gives the stages that ran. Without a judge the offline one replies."""
    if stage not in GROUPS and stage not in STAGES:
        raise ValueError(f"unknown stage {stage}; known: {', '.join([*GROUPS, *STAGES])}")
    ran = []
    for name in GROUPS.get(stage, (stage,)):
        require(spark, work, STAGES[name])
        globals()[name](spark, tables, work, judge=judge)
        ran.append(name)
    return ran
