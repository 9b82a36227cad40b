"""Correction passes over units and turns as set-based plans; the judge is a plug-in.

A judge takes a DataFrame with (key, hyps, neighbors, hotwords, overlap) and returns (key, reply); the shipped one is a
column expression, so that every plan can be checked offline. Passes read a snapshot: no row sees another's change.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.pinyin import reading_distance
from turnloom.operators.hyps import all_agree, best_hyp
from turnloom.operators.validators import EDIT, REPLY, apply_first, apply_located, locate_polish, pass_a_error, pass_b_error, polish_error
from turnloom.session import checkpointed

#: The wrong and right spans the offline judge knows, with tier and anchor.
KNOWN = (("产用", "采用", "C", "hyp"), ("单方接", "单框架", "C", "hotword"), ("帐号", "账号", "B", "hyp"))


def mock_reply(hyps: Column, overlap: Column) -> Column:
    """The offline judge: where a hypothesis has the first known span right while another has it wrong, it is taken as it is;
    else a known wrong span of the first hypothesis that has one is put right; else moss or the first is kept."""
    text_of = lambda m: F.try_element_at(F.filter(hyps, lambda h: h["model"] == m), F.lit(1))
    base = F.coalesce(text_of("moss"), F.try_element_at(hyps, F.lit(1)))
    plain = F.struct(F.coalesce(base["text"], F.lit("")).alias("text"), F.coalesce(base["model"], F.lit("moss")).alias("base_model"), F.array().cast(EDIT).alias("edits"), overlap.alias("overlap")).cast(REPLY)
    wrong, right = KNOWN[0][:2]
    chosen = F.when(F.exists(hyps, lambda h: h["text"].contains(wrong)), F.try_element_at(F.filter(hyps, lambda h: h["text"].contains(right)), F.lit(1)))
    out = F.when(chosen.isNotNull(), F.struct(chosen["text"].alias("text"), chosen["model"].alias("base_model"), F.array().cast(EDIT).alias("edits"), overlap.alias("overlap")).cast(REPLY))
    hit = lambda wrong: F.try_element_at(F.filter(hyps, lambda h: h["text"].contains(wrong)), F.lit(1))
    for wrong, right, tier, anchor in KNOWN:
        h = hit(wrong)
        edit = F.struct(F.lit(wrong).alias("span_asr"), F.lit(right).alias("span_out"), F.lit(tier).alias("tier"), F.lit(None).cast("string").alias("kind"), F.lit(anchor).alias("anchor"), F.lit(None).cast("string").alias("evidence"), F.lit(None).cast("int").alias("start_char"))
        reply = F.struct(F.replace(h["text"], F.lit(wrong), F.lit(right)).alias("text"), h["model"].alias("base_model"), F.array(edit).cast(EDIT).alias("edits"), overlap.alias("overlap")).cast(REPLY)
        out = out.when(h.isNotNull(), reply)
    return out.otherwise(plain)


def unit_texts(units: DataFrame, replies: DataFrame | None = None, fallback: DataFrame | None = None) -> DataFrame:
    """(unit_key, text, skipped_llm, forced_moss, retries, fallback_ok, fallback, last_error): one decision per unit.

    ``units``: unit_key, hyps, contains_overlap. Units whose hypotheses agree off overlap are settled before any judge
    is asked. ``replies``: (unit_key, reply) of a judge, or (unit_key, tries) with its replies in order; ``fallback``:
    (unit_key, reply); without them the offline judge replies. The first valid reply counts, ``retries`` is the number
    of invalid ones before it; after the last one the fallback judge is heard, then the best hypothesis is taken. Under
    overlap a reply that rests on another model than moss without any edit gives the moss text.
    """
    agree = ~F.col("contains_overlap") & all_agree(F.col("hyps"))
    u = units.withColumn("skipped_llm", agree)
    if replies is None:
        u = u.withColumn("tries", F.when(~agree, F.array(mock_reply(F.col("hyps"), F.col("contains_overlap")))))
    else:
        u = u.join(replies if "tries" in replies.columns else replies.select("unit_key", F.array("reply").alias("tries")), "unit_key", "left")
    u = u.withColumn("second", F.lit(None).cast(REPLY)) if fallback is None else u.join(fallback.select("unit_key", F.col("reply").alias("second")), "unit_key", "left")
    error = lambda r: F.when(r.isNull(), "no reply").otherwise(pass_a_error(r))
    heard = F.coalesce("tries", F.array(F.lit(None).cast(REPLY)))
    u = u.withColumn("judged", F.transform(heard, lambda r: F.struct(error(r).alias("error"), r.alias("reply")))).withColumn("err2", error(F.col("second")))
    u = u.withColumn("good", F.try_element_at(F.filter("judged", lambda x: x["error"].isNull()), F.lit(1))["reply"])
    failed = F.coalesce(F.array_position(F.transform("judged", lambda x: x["error"].isNull()), True) - 1, F.lit(-1))
    u = u.withColumns({"failed": F.when(failed < 0, F.size("judged")).otherwise(failed).cast("int"), "err1": F.try_element_at(F.transform("judged", lambda x: x["error"]), F.lit(-1))})
    chosen = F.coalesce("good", F.when(F.col("err2").isNull(), F.col("second")))
    moss = F.filter("hyps", lambda h: (h["model"] == "moss") & (F.coalesce(h["text"], F.lit("")) != ""))
    u = u.withColumn("chosen", F.when(~F.col("skipped_llm"), chosen))
    forced = ~F.col("skipped_llm") & F.col("chosen").isNotNull() & F.col("contains_overlap") & (F.col("chosen.base_model") != "moss") & F.exists("hyps", lambda h: h["model"] == "moss") & (F.size(F.coalesce("chosen.edits", F.array().cast(EDIT))) == 0)
    best = best_hyp(F.col("hyps"), F.col("contains_overlap"))["text"]
    text = F.when(F.col("skipped_llm"), best_hyp(F.col("hyps"), F.lit(False))["text"]).when(F.col("chosen").isNull(), best).when(F.col("forced_moss"), F.coalesce(F.try_element_at(moss, F.lit(1))["text"], best)).otherwise(F.col("chosen.text"))
    asked, lost = ~F.col("skipped_llm"), F.col("chosen").isNull()
    return u.withColumn("forced_moss", F.coalesce(forced, F.lit(False))).select(
        "unit_key", F.coalesce(text, F.lit("")).alias("text"), "skipped_llm", "forced_moss", F.when(asked, F.col("failed")).otherwise(0).alias("retries"),
        (asked & F.col("good").isNull() & ~lost).alias("fallback_ok"), (asked & lost).alias("fallback"),
        F.when(asked & lost, F.when(F.lit(fallback is not None), F.coalesce("err2", "err1")).otherwise(F.col("err1"))).alias("last_error"),
    )


def parse_aliases(hotwords: DataFrame) -> DataFrame:
    """(alt, canon, pos): aliases of hotwords (pos, term) written canon|alt|alt; a later canon wins, an alias keeps its first place."""
    parts = F.filter(F.transform(F.split("term", r"\|"), F.trim), lambda p: p != "")
    x = hotwords.select("pos", parts.alias("p")).where(F.size("p") >= 2)
    x = x.select("pos", F.col("p")[0].alias("canon"), F.posexplode(F.slice("p", 2, 1_000_000)).alias("k", "alt")).where(F.abs(F.length("alt") - F.length("canon")) <= 1)
    return x.groupBy("alt").agg(F.max_by("canon", F.struct("pos", "k")).alias("canon"), F.min(F.struct("pos", "k")).alias("first")).select("alt", "canon", F.col("first.pos").alias("pos"), F.col("first.k").alias("k"))


def rewrite_aliases(texts: DataFrame, aliases: DataFrame, text: str = "text", most: int = 100_000) -> DataFrame:
    """``texts`` with ``new_text`` and ``hits``: every alias replaced by its canon, in list order, chained.

    The aliases are one array from a scalar subquery, refused beyond ``most`` of them. One pattern of all aliases says
    whether a text holds any at all; only those that do (an alias that arises from another's canon needs one first) walk
    through the list.
    """
    near = checkpointed(aliases.where(reading_distance(F.col("alt"), F.col("canon")) <= 2))
    n = near.count()
    if n > most:
        raise ValueError(f"{n} aliases; the list of hotwords is meant to be small")
    listed = near.agg(F.array_sort(F.collect_list(F.struct("pos", "k", "alt", "canon"))).alias("aliases"))
    names = [r.alt for r in near.select("alt").collect()]  # bounded by ``most``
    any_of = "|".join(sorted((r"\Q" + x.replace(r"\E", r"\E\\E\Q") + r"\E" for x in names), key=len)) or r"(?!)"
    none = F.array().cast("array<struct<alt:string,canon:string>>")
    zero = F.struct(F.col("__t").alias("t"), none.alias("h"))
    step = lambda acc, a: F.when(acc["t"].contains(a["alt"]), F.struct(F.replace(acc["t"], a["alt"], a["canon"]).alias("t"), F.concat(acc["h"], F.array(F.struct(a["alt"], a["canon"]))).alias("h"))).otherwise(acc)
    out = texts.withColumns({"__t": F.coalesce(F.col(text), F.lit("")), "__a": listed.scalar()})
    out = out.withColumn("__r", F.when(F.col("__t").rlike(any_of), F.aggregate("__a", zero, step)))
    return out.withColumns({"new_text": F.coalesce("__r.t", "__t"), "hits": F.coalesce("__r.h", none)}).drop("__t", "__a", "__r")


def recurring(texts: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """(canon, recurs): whether the canon of each hotword (pos, term) stands in any of the texts; null texts hold nothing.

    The list of hotwords goes to the texts as one array; what comes back is at most one row for each of them.
    """
    canon = terms.select(F.split("term", r"\|")[0].alias("canon")).where("canon <> ''").distinct()
    listed = canon.agg(F.collect_list("canon")).scalar()
    held = texts.select(F.col(text).alias("__t")).where("__t is not null").withColumn("__a", listed).select(F.explode(F.filter("__a", lambda c: F.col("__t").contains(c))).alias("canon")).distinct()
    return canon.join(held.withColumn("recurs", F.lit(True)), "canon", "left").select("canon", F.coalesce("recurs", F.lit(False)).alias("recurs"))


def _turn_hyps(text: Column, moss: Column) -> Column:
    """Moss, if there is any, and the draft."""
    draft = F.struct(F.lit("draft").alias("model"), text.alias("text"))
    return F.when(moss.isNull(), F.array(draft)).otherwise(F.array(F.struct(F.lit("moss").alias("model"), moss.alias("text")), draft))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _turn_decision(text: Column, overlap: Column, reply: Column, second: Column | None = None) -> Column:
    """(text, path, edits, fallback_ok) after a reply of the second pass, of which only the edits are applied; ``second`` is heard if it is invalid."""
    def decide(r: Column) -> Column:
        error = pass_b_error(r["a"])
        if second is None:
            return _let(F.when(error.isNull(), r["a"]), lambda g: _let(F.when(g.isNotNull(), apply_first(text, g["edits"])).otherwise(text), lambda applied: outcome(r["a"], g, applied, F.lit(False))))
        return _let(
            F.struct(error.alias("ea"), pass_b_error(r["b"]).alias("eb")),
            lambda e: _let(
                F.struct(F.when(e["ea"].isNull(), r["a"]).when(r["b"].isNotNull() & e["eb"].isNull(), r["b"]).alias("r"), (r["a"].isNotNull() & e["ea"].isNotNull() & r["b"].isNotNull() & e["eb"].isNull()).alias("second")),
                lambda g: _let(F.when(g["r"].isNotNull(), apply_first(text, g["r"]["edits"])).otherwise(text), lambda applied: outcome(r["a"], g["r"], applied, g["second"])),
            ),
        )

    def outcome(asked: Column, r: Column, applied: Column, second_ok: Column) -> Column:
        none = F.size(F.coalesce(r["edits"], F.array().cast(EDIT))) == 0
        done = ~none & (applied != text)
        path = (
            F.when(asked.isNull(), F.lit(None).cast("string")).when(r.isNull(), "fallback").when(overlap & ~r["base_model"].isin("moss", "draft") & none, "moss_aware_reject")
            .when(none & (r["text"] != text), "empty_edits_reject").when(done, "llm")
        )
        return F.struct(applied.alias("text"), path.alias("path"), F.when(done, r["edits"]).alias("edits"), second_ok.alias("fallback_ok"))

    return _let(F.struct(reply.alias("a"), *([] if second is None else [second.alias("b")])), decide)


def turn_texts(turns: DataFrame, replies: Callable[[Column, Column], Column] | DataFrame = mock_reply, short_ms: int = 350, fallback: Callable[[Column, Column], Column] | DataFrame | None = None) -> DataFrame:
    """(…, new_text, path, edits, fallback_ok): the second pass over turns with text of at least ``short_ms``, from a snapshot.

    ``turns``: turn_id, text, dur_ms, overlap, moss (text or null). The judge sees moss (if any) and the draft; only its
    edits are applied, never its text. A judge is a function from hypotheses and overlap to a reply, or a table
    (turn_id, reply). ``path`` says what was done: llm, moss_aware_reject, empty_edits_reject, fallback (no valid
    reply), or null for nothing.
    """
    eligible = (F.coalesce("text", F.lit("")) != "") & (F.col("dur_ms") >= short_ms)

    def heard(t: DataFrame, judge: Callable[[Column, Column], Column] | DataFrame | None, name: str) -> DataFrame:
        if isinstance(judge, DataFrame):
            return t.join(judge.select("turn_id", F.col("reply").alias(name)), "turn_id", "left").withColumn(name, F.when(eligible, F.col(name)))
        return t.withColumn(name, F.lit(None).cast(REPLY) if judge is None else F.when(eligible, judge(_turn_hyps(F.col("text"), F.col("moss")), F.col("overlap"))))

    t = heard(heard(turns, replies, "reply"), fallback, "second")
    t = t.withColumn("decided", _turn_decision(F.col("text"), F.col("overlap"), F.col("reply"), None if fallback is None else F.col("second")))
    return t.withColumns({"new_text": F.col("decided.text"), "path": F.col("decided.path"), "edits": F.col("decided.edits"), "fallback_ok": F.col("decided.fallback_ok")}).drop("reply", "second", "decided")


def turn_audits(done: DataFrame) -> DataFrame:
    """(turn_id, path, span_asr, span_out, tier, anchor, fallback_ok): what the second pass did, one row for each edit of a changed turn, placed or not, and one for each refusal."""
    none = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("span_asr", "span_out", "tier", "anchor")]))
    each = F.when(F.col("path") == "llm", F.transform("edits", lambda e: F.struct(e["span_asr"].alias("span_asr"), e["span_out"].alias("span_out"), e["tier"].alias("tier"), e["anchor"].alias("anchor")))).when(F.col("path") == "empty_edits_reject", F.transform(none, lambda x: x.withField("span_asr", F.col("text")))).otherwise(none)
    return done.where("path is not null").select("turn_id", "path", "fallback_ok", F.explode(each).alias("e")).select("turn_id", "path", "e.span_asr", "e.span_out", "e.tier", "e.anchor", "fallback_ok")


def capped(texts: Column, k: int = 20, budget: int = 8192, cost: int = 32) -> Column:
    """The first ``k`` texts within the budget; the first always stays, the first that overflows ends the list."""
    zero = F.struct(F.array().cast("array<string>").alias("t"), F.lit(0).alias("used"), F.lit(False).alias("full"))

    def step(acc: Column, x: Column) -> Column:
        size = F.length(F.coalesce(x, F.lit(""))) + cost
        over = acc["full"] | (F.size(acc["t"]) >= k) | ((F.size(acc["t"]) > 0) & (acc["used"] + size > budget))
        return F.when(over, F.struct(acc["t"].alias("t"), acc["used"].alias("used"), F.lit(True).alias("full"))).otherwise(F.struct(F.concat(acc["t"], F.array(x)).alias("t"), (acc["used"] + size).alias("used"), F.lit(False).alias("full")))

    return F.aggregate(texts, zero, step, lambda acc: acc["t"])


def sequential_texts(turns: DataFrame, replies: Callable[[Column, Column, Column], Column], short_ms: int = 350, k: int = 20) -> DataFrame:
    """(…, new_text, path): the second pass in which later turns see earlier rewrites among their neighbours.

    ``turns`` also has meeting_id and pos, by which the turns of a meeting are ordered (nulls last); ``replies`` gets the
    neighbours' texts as a third column. Neighbours are the first ``k`` other turns of the meeting, so only its first
    k + 1 turns ever change what another turn sees: those are folded in order, one small row per meeting, which then
    meets all turns of the meeting; later ones are judged at once against the final texts. Turns of no meeting are dropped.
    """
    turns = turns.where("meeting_id is not null")
    order = Window.partitionBy("meeting_id").orderBy(F.col("pos").asc_nulls_last(), "turn_id")
    row = F.struct("at", "turn_id", "text", "dur_ms", "overlap", "moss")
    head = turns.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1).groupBy("meeting_id").agg(F.array_sort(F.collect_list(row)).alias("h"))

    def judged(text: Column, x: Column, neighbors: Column) -> Column:
        ok = (F.coalesce(text, F.lit("")) != "") & (x["dur_ms"] >= short_ms)
        return _turn_decision(text, x["overlap"], F.when(ok, replies(_turn_hyps(text, x["moss"]), x["overlap"], neighbors)))

    def step(acc: Column, i: Column) -> Column:
        others = F.filter(F.transform(acc, lambda y, j: F.struct(y["text"].alias("t"), j.alias("j"))), lambda y: y["j"] != i)
        done = judged(F.element_at(acc, i + 1)["text"], F.element_at(F.col("h"), i + 1), capped(F.transform(others, lambda y: y["t"]), k))
        return F.transform(acc, lambda y, j: F.when(j == i, done).otherwise(y))

    zero = F.transform("h", lambda x: F.struct(x["text"].alias("text"), F.lit(None).cast("string").alias("path"), F.lit(None).cast(EDIT).alias("edits"), F.lit(False).alias("fallback_ok")))
    folded = head.select("meeting_id", F.transform("h", lambda x: x["turn_id"]).alias("first"), F.aggregate(F.sequence(F.lit(0), F.size("h") - 1), zero, step).alias("final"))
    folded = folded.withColumn("near", capped(F.transform(F.slice("final", 1, k), lambda y: y["text"]), k))
    begun = F.array_position("first", F.col("turn_id")).cast("int")
    late = judged(F.col("text"), F.struct("dur_ms", "overlap", "moss"), F.col("near"))
    done = turns.join(folded, "meeting_id").withColumn("decided", F.when(begun > 0, F.element_at("final", begun)).otherwise(late)).drop("first", "final", "near")
    return done.withColumns({"new_text": F.col("decided.text"), "path": F.col("decided.path")}).drop("decided")


#: Tokens whose spelling the offline polisher knows.
SPELLINGS = (("wifi", "Wi-Fi"), ("WIFI", "Wi-Fi"), ("gpu", "GPU"), ("Gpu", "GPU"))


def mock_polish(text: Column) -> Column:
    """The offline polisher: edits that spell known tokens right."""
    edit = lambda a, b: F.struct(F.lit(a).alias("span_asr"), F.lit(b).alias("span_out"), F.lit(None).cast("string").alias("tier"), F.lit("codeswitch").alias("kind"), F.lit(None).cast("string").alias("anchor"), F.lit("token is in the text").alias("evidence"), F.lit(None).cast("int").alias("start_char"))
    edits = F.filter(F.array(*[edit(a, b) for a, b in SPELLINGS]).cast(EDIT), lambda e: text.contains(e["span_asr"]))
    return F.struct(text.alias("text"), F.lit("draft").alias("base_model"), edits.alias("edits"), F.lit(False).alias("overlap")).cast(REPLY)


def with_citations(grid: DataFrame, hyps: DataFrame, hotwords: DataFrame, k: int = 20) -> DataFrame:
    """``grid`` with the texts an edit may cite, joined by spaces, in cite_hyps, cite_neighbors and cite_hotwords.

    ``grid``: unit_key, meeting_id, unit_id, text; ``hyps``: unit_key, hyps; ``hotwords``: pos, term. Neighbours are the
    first ``k`` other rows of the meeting within the budget, in order of unit_id's number. Only the first k + 1 rows can
    be anyone's neighbours: they are the small side, and all later rows of a meeting share one text.
    """
    grid = checkpointed(grid)
    order = Window.partitionBy("meeting_id").orderBy(F.length("unit_id").asc_nulls_last(), "unit_id", "unit_key")
    head = grid.where("meeting_id is not null").withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    head = head.groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct("at", "unit_key", F.coalesce("text", F.lit("")).alias("text")))).alias("head"))
    blob = lambda rows: F.array_join(capped(F.transform(rows, lambda x: x["text"]), k), " ")
    own = head.select(F.explode(F.transform("head", lambda x: F.struct(x["unit_key"].alias("unit_key"), blob(F.filter("head", lambda y: y["at"] != x["at"])).alias("own")))).alias("x")).select("x.unit_key", "x.own")
    # The join on the meeting comes last, so that the text shared by its rows is in no shuffle of rows.
    rows = grid.join(hyps, "unit_key", "left").join(own, "unit_key", "left").join(head.select("meeting_id", blob(F.col("head")).alias("shared")), "meeting_id", "left")
    terms = F.array_sort(F.collect_list(F.struct("pos", "term")))
    cite_hotwords = hotwords.agg(F.array_join(F.transform(terms, lambda x: x["term"]), " ")).scalar()
    cite_hyps = F.coalesce(F.array_join(F.transform("hyps", lambda h: F.coalesce(h["text"], F.lit(""))), " "), F.lit(""))
    return rows.withColumns({"cite_hyps": cite_hyps, "cite_neighbors": F.coalesce("own", "shared", F.lit("")), "cite_hotwords": cite_hotwords}).drop("own", "shared")


def _asked(replies: Callable[..., Column], text: Column, *cited: Column) -> Column:
    """The reply to a text, with the texts it may cite where the judge takes them."""
    try:
        inspect.signature(replies).bind(text, *cited)
    except TypeError:
        return replies(text)
    return replies(text, *cited)


def polish_texts(rows: DataFrame, replies: Callable[..., Column] | DataFrame = mock_polish, short_ms: int = 350, key: str = "unit_key") -> DataFrame:
    """(…, new_text, path, located): polish of texts from a snapshot.

    ``rows``: text, and the texts an edit may cite in cite_hyps, cite_neighbors and cite_hotwords. ``replies`` gets the
    text, and if it takes four columns those three as well; or it is a table (key, reply). Where rows have dur_ms, those
    under ``short_ms`` aren't asked about. An invalid reply leaves the text (fallback), one without
    edits but with another text is refused (empty_edits_reject).
    """
    cited = [F.col(c) for c in ("cite_hyps", "cite_neighbors", "cite_hotwords")]
    ok = F.coalesce("text", F.lit("")) != ""
    if "dur_ms" in rows.columns:
        ok = ok & (F.col("dur_ms") >= short_ms)
    if isinstance(replies, DataFrame):
        r = rows.join(replies.select(key, "reply"), key, "left").withColumn("reply", F.when(ok, F.col("reply")))
    else:
        r = rows.withColumn("reply", F.when(ok, _asked(replies, F.col("text"), *cited)))
    err = polish_error(F.col("reply"), F.col("text"), *cited)
    r = r.withColumn("err", F.when(F.col("reply").isNotNull(), err)).withColumn("located", F.when(F.col("err").isNull() & F.col("reply").isNotNull(), locate_polish(F.col("text"), F.col("reply.edits"))))
    new = F.when(F.col("located").isNull(), F.col("text")).otherwise(apply_located(F.col("text"), F.col("located")))
    none = F.size(F.coalesce("reply.edits", F.array().cast(EDIT))) == 0
    r = r.withColumn("new_text", new)
    path = F.when(F.col("err").isNotNull(), "fallback").when(F.col("reply").isNotNull() & none & (F.col("reply.text") != F.col("text")), "empty_edits_reject").when(F.col("new_text") != F.col("text"), "llm")
    return r.withColumn("path", path).drop("reply", "err")


def polish_audits(done: DataFrame, key: str = "unit_key") -> DataFrame:
    """(key, path, kind, anchor, span_asr, span_out, start_char, end_char, evidence): one row for each placed edit of a changed text, and one for each refusal or fallback."""
    fields = ("kind", "anchor", "span_asr", "span_out", "start_char", "end_char", "evidence")
    none = F.array(F.struct(*[F.lit(None).cast("int" if f.endswith("char") else "string").alias(f) for f in fields]))
    each = F.when(F.col("path") == "llm", F.transform("located", lambda x: F.struct(*[x[f].alias(f) for f in fields]))).otherwise(none)
    return done.where("path is not null").select(key, "path", F.explode(each).alias("e")).select(key, "path", *[f"e.{f}" for f in fields])


def restore_moss(turns: DataFrame) -> DataFrame:
    """``turns`` with ``new_text`` and ``restored``: blank drafts under overlap get the moss text; nothing else changes."""
    need = F.col("overlap") & (F.trim(F.coalesce("text", F.lit(""))) == "") & (F.coalesce("moss", F.lit("")) != "")
    return turns.withColumn("restored", need).withColumn("new_text", F.when(need, F.col("moss")).otherwise(F.col("text")))
