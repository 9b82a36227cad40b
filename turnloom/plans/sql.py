"""Equivalent SQL of the core queries that SQL can express on whole tables."""

from __future__ import annotations

from turnloom.functions.text import CER_PUNCT
from turnloom.operators import prompts
from turnloom.operators.passes import KNOWN
from turnloom.operators.textgrid import ENDS, JOINER
from turnloom.plans.queries import DAMAGE

_INVISIBLE = "­͏؜᠎​-‏‪-‮⁠-⁤⁦-⁯﻿"
_WS = "\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_CUT = "".join("\\" + c if c in "[]()-\\^\".?!" else ("''" if c == "'" else c) for c in CER_PUNCT)


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _norm(c: str) -> str:
    return f"regexp_replace({c}, '[{_WS}{_CUT}]', '', 'g')"


def _label(c: str) -> str:
    folded = f"translate(regexp_replace({c}, '[{_INVISIBLE}]', '', 'g'), '０１２３４５６７８９', '0123456789')"
    return f"coalesce('speaker_' || nullif(regexp_extract({folded}, '(?i)^[^\\pL\\pN]*(speaker|spk|s|发言人|说话人)[\\s_-]*0*([0-9]+)[^\\pL\\pN]*$', 2), ''), 'unknown')"


def _current(name: str, table: str, keys: str) -> str:
    return f"{name} as (select * exclude (rn) from (select *, row_number() over (partition by {keys} order by loaded_at desc) as rn from {table}) where rn = 1)"


_T, _U, _H, _I = _current("t", "turns", "turn_id"), _current("u0", "units", "unit_key"), _current("h", "hyps", "unit_key, model"), _current("i", "llm_infer", "infer_id")
_U = _U + ", u as (select * replace (coalesce(contains_overlap, false) as contains_overlap, coalesce(heavy_overlap, false) as heavy_overlap, coalesce(skip_asr, false) as skip_asr) from u0)"
_V = f"""v as (select *, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e, {_label("speaker_id")} as who from t
  where isfinite(start_s) and isfinite(end_s) and end_s > start_s and round((end_s - start_s) * 1e6) >= 10000)"""
_REACH = "w as (select meeting_id, s, e, max(e) over (partition by meeting_id order by s, e rows between unbounded preceding and 1 preceding) as m from v)"
_MEM = "mem as (select unit_key, meeting_id, k, ti as turn_index from (select unit_key, meeting_id, unnest(turn_indices) as ti, generate_subscripts(turn_indices, 1) as k from u))"
_SPAN = "sp as (select unit_key, mem.meeting_id, min(s) as s, max(e) as e from mem join v on mem.meeting_id = v.meeting_id and mem.turn_index = v.turn_index group by all)"
_JOINED = f"""jt as (select unit_key, list_filter(list({_strip("coalesce(text, '')")} order by k), lambda x: x <> '') as p from mem join v on mem.meeting_id = v.meeting_id and mem.turn_index = v.turn_index group by unit_key),
  jx as (select unit_key, len(p) as n, case when len(p) = 0 then '' else list_reduce(p, lambda a, b: a || case when contains('{ENDS}', right(a, 1)) then '' else '{JOINER}' end || b) end as text from jt)"""
_ALIAS = """term as (select min(pos) as pos, term from (select pos, trim(case when canon is null then coalesce(alt, '') when alt is null then canon else canon || '|' || alt end) as term from hotwords) where term <> '' and term not like '#%' group by term),
  part as (select pos, list_filter(list_transform(string_split(term, '|'), lambda x: trim(x)), lambda x: x <> '') as p from term),
  al as (select pos, p[1] as canon, unnest(p[2:]) as alt, generate_subscripts(p[2:], 1) as k from part where len(p) >= 2)"""
_PIECES = """pc as (select turn_id, meeting_id, turn_index, who, n, k, s + cast(round((e - s) * k / n::double) as bigint) as ps, s + cast(round((e - s) * (k + 1) / n::double) as bigint) as pe
  from (select *, unnest(range(n)) as k from (select *, case when e - s <= 30000 then 1 else cast(power(2, ceil(round(log2((e - s) / 30000.0::double), 9))) as int) end as n from v)))"""


_BY_TURN = """m as (select unit_key, list(v.turn_index order by k) as ti, list(greatest((e - s) / 1000.0::double, 1e-6) order by k) as du from mem join v on mem.meeting_id = v.meeting_id and mem.turn_index = v.turn_index group by unit_key),
  j as (select unit_key, model, coalesce(text, '') as text, ti, du, len(ti) as n, list_reduce(du, lambda a, b: a + b) as tot, list_filter(string_split(coalesce(text, ''), '。'), lambda x: x <> '') as parts from h join m using (unit_key)),
  kk as (select *, list_transform(du, lambda d: cast(round_even(length(text) * (d / tot), 0) as int)) as tk from j),
  xx as (select *, unnest(ti) as turn_index, generate_subscripts(ti, 1) as r from kk),
  yy as (select *, case when n = 1 then text when len(parts) = n then parts[r]
    else replace(regexp_replace(substring(text, coalesce(list_sum(tk[1:r - 1]), 0)::bigint + 1, case when r = n then length(text) else tk[r] end), '^。+|。+$', '', 'g'), '。。', '。') end as p from xx),
  bt as (select unit_key, turn_index, model, case when coalesce(p, '') <> '' then p else text end as text from yy)"""


def _mock(said: str) -> str:
    """Text, base model, and wrong and right span of the offline judge's reply; ``said`` is a list of {model, text} in order."""
    has = lambda w: f"list_filter({said}, lambda z: contains(z.text, '{w}'))"
    wrong, right = KNOWN[0][:2]
    out = [f"when len({has(wrong)}) > 0 and len({has(right)}) > 0 then {{'t': {has(right)}[1].text, 'm': {has(right)}[1].model, 'w': null, 'r': null}}"]
    out += [f"when len({has(w)}) > 0 then {{'t': replace({has(w)}[1].text, '{w}', '{r}'), 'm': {has(w)}[1].model, 'w': '{w}', 'r': '{r}'}}" for w, r, _, _ in KNOWN]
    base = f"coalesce(list_filter({said}, lambda z: z.model = 'moss')[1], {said}[1])"
    return f"case {' '.join(out)} else {{'t': coalesce({base}.text, ''), 'm': coalesce({base}.model, 'moss'), 'w': null, 'r': null}} end"


_ONE_BYTE = "array_to_string(list_transform(range(1, 128), lambda c: chr(c::int)), '')"
#: Edit distance of r and h in characters. DuckDB counts bytes, so what the two have in common at both ends is cut off and the characters of the rest are renamed to one-byte ones,
#: pair by pair: those of one side alone match nothing and are one character. The few rests with more than 125 that stand on both sides are walked row by row.
_NARROW = "translate({0}, array_to_string(list_concat(cm, list_filter({1}, lambda x: not list_contains(cm, x))), ''), substring(" + _ONE_BYTE + ", 3, len(cm)) || repeat(chr({2}), len({1})))"
_SAME = "len(list_filter(range(1, least(length({0}), length({1})) + 1), lambda q: {2}({0}, q) = {2}({1}, q)))"
_CER = f"""ca as (select * replace ({_norm("coalesce(r, '')")} as r, {_norm("coalesce(h, '')")} as h) from cp),
  cb as (select * exclude (r, h), r as r0, h as h0, substring(r, k + 1) as r, substring(h, k + 1) as h from (select *, case when r = h then length(r) else {_SAME.format("r", "h", "left")} end as k from ca)),
  cc as (select * replace (left(r, length(r) - k2) as r, left(h, length(h) - k2) as h) from (select *, {_SAME.format("r", "h", "right")} as k2 from cb)),
  cx as materialized (select *, row_number() over () as id, list_filter(rs, lambda x: list_contains(hs, x)) as cm from (select *, list_distinct(string_split(r, '')) as rs, list_distinct(string_split(h, '')) as hs from cc)),
  wide as materialized (select id, r, h from cx where len(cm) > 125),
  dp as (select id, 0 as i, j, j as v from (select id, unnest(range(0, length(h) + 1)) as j from wide)
    union all select id, i + 1, j, min(m - j) over (partition by id order by j rows unbounded preceding) + j
    from (select id, i, j, case when j = 0 then i + 1 else least(v + 1, lag(v) over (partition by id order by j) + case when substring(r, i + 1, 1) = substring(h, j, 1) then 0 else 1 end) end as m from dp join wide using (id) where i < length(r))),
  cd as (select cx.*, case when cx.r = '' or cx.h = '' then length(cx.r) + length(cx.h) when len(cm) > 125 then (select v from dp where dp.id = cx.id and dp.i = length(cx.r) and dp.j = length(cx.h)) else levenshtein({_NARROW.format("cx.r", "rs", 1)}, {_NARROW.format("cx.h", "hs", 2)}) end as edits from cx),
  ce as (select *, length(r0) as n_ref, case when r0 = '' and h0 = '' then 0.0 when r0 = '' then 1.0 else edits / length(r0)::double end as cer from cd)"""
_CER_RATES = "round(coalesce(avg(cer), 0.0), 9) as mean_cer, round(coalesce(sum(edits) filter (where n_ref > 0) / sum(n_ref)::double, 0.0), 9) as corpus_cer"
_UNIT_PAIRS = "cp as (select h.unit_key, h.model, jx.text as r, h.text as h from h join jx using (unit_key))"


def _ruined(c: str, pairs: tuple[tuple[str, str], ...]) -> str:
    for old, new in pairs:
        c = f"replace({c}, '{old}', '{new}')"
    return c


_BLOCKS = "(?is)<think>.*?</think>|<thinking>.*?</thinking>|<reason>.*?</reason>|<reasoning>.*?</reasoning>"
#: The object of a reply: the text from its first to its last brace, think blocks aside, if that is JSON.
_RUINED = f"""ob as (select infer_id, user_text, regexp_extract(regexp_replace(coalesce(response, ''), '{_BLOCKS}', '', 'g'), '(?s)[{{].*[}}]') as o from i),
  ruin as (select infer_id, coalesce(user_text, '') as source, unnest([{", ".join(f"{{'damage': '{name}', 'j': {_ruined('jt', pairs)}}}" for name, pairs in DAMAGE)}], recursive := true)
    from (select *, case when json_valid(o) then o end as jt from ob)),
  ed0 as (select infer_id, source, damage, case when json_valid(j) then j end as j, j as raw from ruin),
  ed as (select *, json_type(j) as root, json_type(j, '$.edits') as ety, case when json_type(j, '$.edits') = 'ARRAY' then coalesce(json_array_length(j, '$.edits'), 0) else 0 end as ne from ed0),
  mem as (select infer_id, source, damage, root, ety, j, raw, unnest(case when ne > 0 then range(ne::bigint) else [null] end) as k from ed),
  f as (select *, json_extract(j, '$.edits[' || k || ']') as e from mem),
  g as (select *, json_type(e) as et, e->>'span_asr' as a, e->>'span_out' as b, e->>'tier' as tier, e->>'kind' as kind, coalesce(e->>'anchor', '') as anchor, coalesce(e->>'evidence', '') as evidence from f),
  lost as (select distinct infer_id, damage, case when raw is null then 'no JSON object' when j is null then 'LLM JSON parse failed' when root <> 'OBJECT' then 'LLM JSON root must be object' end as lost,
    j->>'text' as text, case when json_type(j, '$.text') is null or json_type(j, '$.base_model') is null then 'missing text or base_model' when ety is not null and ety <> 'ARRAY' then 'edits must be list' end as head,
    case when json_type(j, '$.text') is null then 'missing text' when ety is not null and ety <> 'ARRAY' then 'edits must be list' end as phead from g)"""
_SQUEEZE = "regexp_replace({}, '[\\s\\x{{a0}}\\x{{3000}}]', '', 'g')"
#: Edits between two spans: DuckDB counts bytes, which is right where one side is empty (its letters are counted) or the difference is ASCII, as in the drill.
_AWAY = f"case when {_SQUEEZE.format('a')} = '' then length({_SQUEEZE.format('b')}) else levenshtein({_SQUEEZE.format('a')}, {_SQUEEZE.format('b')}) end"
_JUDGED = f"""er as (select infer_id, damage, k,
    case when e is null then null when et <> 'OBJECT' then 'edit must be dict' when tier is null or a is null or b is null then 'edit missing tier/span fields' when tier not in ('A', 'B', 'C', 'punct') then 'bad tier ' || tier when tier = 'C' and anchor = '' then 'Tier C requires anchor' end as e1,
    case when et = 'OBJECT' and tier <> 'punct' and abs(length(b) - length(a)) > 1 then 'span_local_char_count failed for ''' || a || ''' -> ''' || b || '''' end as e2,
    case when et <> 'OBJECT' then null when tier = 'B' and {_SQUEEZE.format("a")} <> {_SQUEEZE.format("b")} then 'Tier B requires exact pinyin: ''' || a || ''' vs ''' || b || '''' when tier = 'C' and anchor = '' then 'Tier C requires anchor'
      when tier = 'C' and anchor not in ('hyp', 'neighbor_draft', 'meeting_draft', 'hotword') then 'bad Tier C anchor ' || anchor when tier = 'C' and ({_AWAY}) > 2 then 'Tier C pinyin edit distance ' || ({_AWAY}) || ' > 2' end as e3,
    case when et = 'OBJECT' and tier not in ('B', 'C', 'punct') then 'tier ''' || tier || ''' not allowed in this pass' end as e4, et = 'OBJECT' and tier = 'A' as is_a from g),
  fe as (select infer_id, damage, arg_min(e1, k) filter (where e1 is not null) as s1, arg_min(e2, k) filter (where e2 is not null) as s2, arg_min(e3, k) filter (where e3 is not null) as s3,
    arg_min(coalesce(e4, e3), k) filter (where coalesce(e4, e3) is not null) as s4, coalesce(bool_or(is_a), false) as any_a from er group by all)"""
_CORE = "regexp_replace({}, '[^一-鿿A-Za-z0-9]', '', 'g')"
_KIND_OF = "case when regexp_matches({0}, '[一-鿿]') and regexp_matches({0}, '[A-Za-z]') then 'mixed' when regexp_matches({0}, '[一-鿿]') and not regexp_matches({0}, '[0-9]') then 'cjk' when regexp_matches({0}, '[A-Za-z]') then 'latin' end"
_POLISHED = f"""pr0 as (select g.infer_id, g.damage, k, et, a, b, lower(kind) as kind, anchor, evidence, source, lost.text, {_CORE.format("coalesce(a, '')")} as ca, {_CORE.format("coalesce(b, '')")} as cb,
    lower(regexp_replace(coalesce(a, ''), '[^A-Za-z]', '', 'g')) as la, lower(regexp_replace(coalesce(b, ''), '[^A-Za-z]', '', 'g')) as lb from g join lost using (infer_id, damage) where e is not null),
  pr1 as (select *, {_KIND_OF.format("ca")} as sa, {_KIND_OF.format("cb")} as sb, la <> '' and la = lb and not regexp_matches(a, '[一-鿿]') and not regexp_matches(b, '[一-鿿]') as same from pr0),
  pr2 as (select *, coalesce(sa = 'cjk' and sb = 'cjk', false) as cjk, coalesce(sa = 'latin' and sb = 'latin', false) as lat, coalesce(sa <> sb or (sa = 'mixed' and sb = 'mixed'), false) as sw from pr1),
  pe as (select infer_id, damage, k,
    case when et <> 'OBJECT' then 'edit must be dict' when a is null or b is null or kind is null then 'edit missing span_asr/span_out/kind' when kind not in ('punc', 'entity', 'codeswitch') then 'bad kind ''' || kind || '''' end as p1,
    case when et <> 'OBJECT' or a = b then null when a = '' then 'insertions forbidden' when not contains(text, a) then 'span_asr not in text' when regexp_replace(a, '[^\\p{{Nd}}]', '', 'g') <> regexp_replace(b, '[^\\p{{Nd}}]', '', 'g') then 'number rewrite forbidden'
      when length(b) > 0 and length(b) < length(a) and length(a) % greatest(length(b), 1) = 0 and repeat(b, (length(a) // greatest(length(b), 1))::bigint) = a then 'repeat collapse forbidden'
      when cjk and abs(length(ca) - length(cb)) > 2 then 'cjk substitution exceeds ±2 character slack' when not cjk and starts_with(b, a) and {_CORE.format("substring(b, length(a) + 1)")} <> '' then 'added content forbidden'
      when not cjk and starts_with(a, b) and {_CORE.format("substring(a, length(b) + 1)")} <> '' then 'deleted content forbidden' when kind = 'punc' and ca <> cb then 'punc cannot change words' when kind = 'punc' then null
      when lat and not same then 'latin rewrite must keep the same letters' when not cjk and not lat and not sw then 'unsupported script mix' when same then null when trim(evidence) = '' then 'missing evidence'
      when anchor not in ('hyp', 'neighbor_draft', 'meeting_draft', 'hotword') then 'bad/missing anchor ''' || anchor || '''' when trim(b) = '' or not contains(lower(source), lower(trim(b))) then 'span_out not found in ' || anchor || ' evidence' end as p2,
    case when et = 'OBJECT' and kind in ('punc', 'entity', 'codeswitch') and coalesce(a, '') <> coalesce(b, '') and coalesce(a, '') <> '' and instr(text, a) > 0 then a end as spot, b, text from pr2),
  pf as (select infer_id, damage, arg_min(p1, k) filter (where p1 is not null) as s1, arg_min(p2, k) filter (where p2 is not null) as s2, count(spot) as n, max(spot) as a, arg_max(b, spot) as b from pe group by all)"""


_PASS_A = f"""said as (select unit_key, list({{'model': model, 'text': text}} order by model) as hs, count(distinct case when coalesce(text, '') <> '' then {_norm("text")} end) <= 1 as agree from h group by unit_key),
  pa0 as (select unit_key, meeting_id, contains_overlap as o, not contains_overlap and agree as skipped_llm, hs, list_filter(hs, lambda z: coalesce(z.text, '') <> '') as ful, {_mock("hs")} as r from said join u using (unit_key) where not skip_asr),
  pa1 as (select *, list_filter(ful, lambda z: z.model = 'moss')[1].text as moss, coalesce(ful[1].text, hs[1].text) as first,
    case when unit_key % 13 = 0 or unit_key % 17 = 0 then 2 when unit_key % 11 = 0 then 1 else 0 end as bad, unit_key % 13 = 0 and unit_key % 221 <> 0 as saved, unit_key % 221 = 0 as unheard,
    case when unit_key % 13 <> 0 and unit_key % 17 <> 0 and unit_key % 11 <> 0 and unit_key % 7 = 0 then {{'t': coalesce(hs[1].text, ''), 'm': hs[1].model, 'w': null, 'r': null}} else r end as said from pa0),
  pa2 as (select *, not skipped_llm and bad = 2 and not saved as lost, coalesce(not skipped_llm and o and said.m <> 'moss' and said.w is null and len(list_filter(hs, lambda z: z.model = 'moss')) > 0, false) as unsure from pa1),
  pa as (select unit_key, meeting_id, coalesce(case when skipped_llm then first when lost or (unsure and moss is not null) then case when o and moss is not null then moss else first end when unsure then first else said.t end, '') as text,
    skipped_llm, unsure and not lost as forced_moss, case when skipped_llm then 0 else bad end as retries, not skipped_llm and bad = 2 and saved as fallback_ok, lost as fallback, case when lost then case when unheard then 'no reply' else 'bad tier Q' end end as last_error from pa2)"""
_TURN_ROWS = f"""flags as (select meeting_id, turn_index, bool_or(o) as o from (select meeting_id, unnest(turn_indices) as turn_index, contains_overlap as o from u) group by all),
  moss as (select meeting_id, turn_index, max_by(bt.text, unit_key) as moss from bt join u using (unit_key) where model = 'moss' group by all),
  pt as (select turn_id, meeting_id, v.turn_index, v.text, e - s as dur, coalesce(o, false) as o, moss, coalesce(v.text, '') <> '' and e - s >= 350 as asked from v left join flags using (meeting_id, turn_index) left join moss using (meeting_id, turn_index))"""


def _two(text: str, moss: str) -> str:
    return _mock(f"case when {moss} is null then [{{'model': 'draft', 'text': {text}}}] else [{{'model': 'moss', 'text': {moss}}}, {{'model': 'draft', 'text': {text}}}] end")


def _put(text: str, r: str) -> str:
    """The first wrong span of a reply put right."""
    return f"case when {r}.w is not null and instr({text}, {r}.w) > 0 then substring({text}, 1, instr({text}, {r}.w) - 1) || {r}.r || substring({text}, instr({text}, {r}.w) + length({r}.w)) else {text} end"


_PASS_B = f"""{_TURN_ROWS},
  pr as (select *, turn_id % 11 = 0 as broken, turn_id % 22 = 0 as saved, case when not asked then null when turn_id % 22 = 0 then {{'t': text, 'm': 'draft', 'w': '。', 'r': '.', 'n': 1}} when turn_id % 11 = 0 then null when turn_id % 7 = 0 then {{'t': text, 'm': 'qwen', 'w': null, 'r': null, 'n': 0}}
    when turn_id % 5 = 0 then {{'t': text || 'x', 'm': 'draft', 'w': null, 'r': null, 'n': 0}} when turn_id % 3 = 0 and contains(text, '，') then {{'t': text, 'm': 'draft', 'w': '，', 'r': ',', 'n': 2}} else struct_insert({_two("text", "moss")}, n := 1) end as r from pt),
  pb as (select *, {_put("text", "r")} as app from pr),
  pq as (select *, asked and saved as fallback_ok, case when not asked then null when r is null then 'fallback' when o and r.m not in ('moss', 'draft') and r.w is null then 'moss_aware_reject' when r.w is null and r.t <> text then 'empty_edits_reject' when r.w is not null and app <> text then 'llm' end as path from pb)"""

#: Whether one of the first 20 texts of a list within the budget has a semicolon.
_SPREAD = "len(list_filter(range(1, least(20, len({0})) + 1), lambda q: contains(coalesce({0}[q], ''), '；') and (q = 1 or list_sum(list_transform({0}[1:q], lambda x: length(coalesce(x, '')) + 32)) <= 8192))) > 0"


def _cascade(own: str, moss: str, asked: str, near: str) -> str:
    mock = _two(own, moss)
    return f"case when not {asked} then null when contains({own}, '？') then {{'t': {own}, 'm': 'draft', 'w': '？', 'r': '；'}} when contains({own}, '。') and {_SPREAD.format(near)} then {{'t': {own}, 'm': 'draft', 'w': '。', 'r': '；'}} else {mock} end"


_PATH = "case when {r} is null then null when {o} and {r}.m not in ('moss', 'draft') and {r}.w is null then 'moss_aware_reject' when {r}.w is null and {r}.t <> {t} then 'empty_edits_reject' when {r}.w is not null and {p} <> {t} then 'llm' end"
_SEQUENTIAL = f"""{_TURN_ROWS},
  sq as (select *, row_number() over (partition by meeting_id order by turn_index) - 1 as pos from pt),
  hd as (select meeting_id, list({{'id': turn_id, 'text': text, 'moss': moss, 'o': o, 'long': dur >= 350}} order by pos) as h from sq where pos <= 20 group by meeting_id),
  fold as (select meeting_id, h, 0 as i, list_transform(h, lambda x: x.text) as ts, []::varchar[] as ps from hd
    union all
    select meeting_id, h, i + 1, list_transform(range(1, len(ts) + 1), lambda q: case when q = i + 1 then app else ts[q] end), list_append(ps, {_PATH.format(r="r", o="h[i + 1].o", t="ts[i + 1]", p="app")})
    from (select *, {_put("ts[i + 1]", "r")} as app from (select *, {_cascade("ts[i + 1]", "h[i + 1].moss", "(coalesce(ts[i + 1], '') <> '' and h[i + 1].long)", "near")} as r
      from (select *, list_transform(list_filter(range(1, len(ts) + 1), lambda q: q <> i + 1), lambda q: ts[q]) as near from fold where i < len(h))))),
  ended as (select * from fold where i = len(h)),
  early as (select unnest(list_transform(range(1, len(h) + 1), lambda q: {{'turn_id': h[q].id, 'new_text': ts[q], 'path': ps[q]}}), recursive := true) from ended),
  late as (select turn_id, {_put("text", "r")} as new_text, {_PATH.format(r="r", o="o", t="text", p=_put("text", "r"))} as path
    from (select sq.*, {_cascade("text", "moss", "asked", "near")} as r from sq join (select meeting_id, ts[1:20] as near from ended) using (meeting_id) where pos > 20))"""


_BUILT = """o as (select *, row_number() over (partition by meeting_id order by ps, pe, turn_index, k) as r from pc),
            g as (select meeting_id, r, 0 as unit_seq, ps as us, pe as ue, who, turn_index from o where r = 1
              union all
              select o.meeting_id, o.r, case when fit then g.unit_seq else g.unit_seq + 1 end, case when fit then g.us else o.ps end, o.pe, o.who, o.turn_index
              from g join (select o.*, null as z from o) o on o.meeting_id = g.meeting_id and o.r = g.r + 1,
                lateral (select o.who = g.who and o.ps - g.ue between 0 and 5000 and o.pe - g.us <= 30000 as fit)),
            x as (select meeting_id, unit_seq, min(us) as start_ms, max_by(ue, r) as end_ms, any_value(who) as speaker, list(turn_index order by r) as ti from g group by meeting_id, unit_seq),
            y as (select *, list_filter(ti, lambda a, n: n = 1 or ti[n - 1] <> a) as td from x),
  ub as (select meeting_id, unit_seq, printf('unit_%04d', unit_seq) as unit_id, start_ms, end_ms, speaker, array_to_string(td, ',') as turn_indices, end_ms - start_ms < 350 as skip_asr,
              case when end_ms - start_ms < 350 then 'too_short' end as skip_reason, len(td) > 1 as moss_merged from y)"""
_NEAR = """n as (select unit_key, v.turn_index, v.who, v.text, abs(sp.s + sp.e - v.s - v.e) as d from sp join v on sp.meeting_id = v.meeting_id and abs(sp.s + sp.e - v.s - v.e) <= 1200000
              where not exists (select 1 from mem where mem.unit_key = sp.unit_key and mem.turn_index = v.turn_index)),
            r as (select *, row_number() over (partition by unit_key order by d, turn_index) as rank from n),
            c as (select *, sum(length(coalesce(text, '')) + 32) over (partition by unit_key order by rank) as used from r where rank <= 20),
  near as (select unit_key, string_agg(to_json({'turn_index': turn_index, 'speaker': who, 'text': coalesce(text, '')})::varchar, chr(10) order by rank) as prompt from c where rank = 1 or used <= 8192 group by unit_key)"""
_LITERAL = {"hyps": "hyps", "hotwords": "w", "neighbors": "near", "overlap": "case when o then 'true' else 'false' end", "heavy": "case when v then 'true' else 'false' end"}


def _template(text: str) -> str:
    """A prompt's template as a concatenation of literals and columns."""
    for k, c in _LITERAL.items():
        text = text.replace("{" + k + "}", f"\0{c}\0")
    parts = text.split("\0")
    return " || ".join("'" + x.replace("'", "''") + "'" if i % 2 == 0 else f"({x})" for i, x in enumerate(parts))


_PROMPT = _template(prompts._JUDGE)


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {
        "cer_pairs": f"with recursive {_T}, {_U}, {_H}, {_V}, {_MEM}, {_JOINED}, {_UNIT_PAIRS}, {_CER} select unit_key, model, n_ref::int as n_ref, edits::int as edits, round(cer, 9) as cer from ce",
        "eval_cer": f"with recursive {_T}, {_U}, {_H}, {_V}, {_MEM}, {_JOINED}, {_UNIT_PAIRS}, {_CER} select model, count(*) as n, {_CER_RATES} from ce group by model",
        "eval_documents": f"""with recursive {_T}, {_U}, {_H}, {_V}, {_MEM}, {_BY_TURN}, {_TURN_ROWS}, pp as (select meeting_id, text, moss, row_number() over (partition by meeting_id order by turn_index) - 1 as pos from pt),
            cp as (select meeting_id, text as r, moss as h from pp where moss is not null), {_CER}
            select meeting_id, count(moss) as n_turns, count(moss) as n_hyp, count(*) as n_ref, coalesce(any_value(mean_cer), 0.0) as mean_cer, coalesce(any_value(corpus_cer), 0.0) as corpus_cer
            from pp left join (select meeting_id, {_CER_RATES} from ce group by meeting_id) using (meeting_id) group by meeting_id""",
        "pass_a_mock": f"with {_U}, {_H}, {_PASS_A} select unit_key, text, skipped_llm, forced_moss, retries, fallback_ok, fallback, last_error from pa",
        "pass_stats_a": f"""with {_U}, {_H}, {_PASS_A}, c as (select meeting_id, count(*) as n_units, count(*) filter (where skipped_llm) as skipped_llm, sum(retries)::bigint as retries_total, count(*) filter (where fallback) as fallback_to_best_hyp,
            count(*) filter (where fallback_ok) as fallback_judge_success from pa group by meeting_id)
            select *, round(case when n_units > skipped_llm then retries_total / (n_units - skipped_llm)::double else 0.0 end, 9) as approx_retry_rate, coalesce(round(case when n_units > skipped_llm then retries_total / (n_units - skipped_llm)::double else 0.0 end, 9) > 0.05, false) as suggest_raise_temperature from c""",
        "pass_b_mock": f"with {_T}, {_U}, {_H}, {_V}, {_MEM}, {_BY_TURN}, {_PASS_B} select turn_id, case when r is null then text else app end as new_text, path, fallback_ok from pq",
        "pass_b_sequential": f"with recursive {_T}, {_U}, {_H}, {_V}, {_MEM}, {_BY_TURN}, {_SEQUENTIAL} select turn_id, new_text, path from early union all select turn_id, new_text, path from late",
        "pass_stats_b": f"""with {_T}, {_U}, {_H}, {_V}, {_MEM}, {_BY_TURN}, {_PASS_B}, au as (select path, fallback_ok, case when path = 'llm' then coalesce(r.n, 1) else 1 end as n from pq where path is not null
              union all select 'moss_force', false, 1 from pt where o and trim(coalesce(text, '')) = '' and coalesce(moss, '') <> '')
            select coalesce(sum(n), 0)::bigint as n_audits, coalesce(sum(n) filter (where path = 'hotword_alias'), 0)::bigint as hotword_alias, coalesce(sum(n) filter (where path = 'llm'), 0)::bigint as llm_edits, coalesce(sum(n) filter (where path = 'fallback'), 0)::bigint as llm_fallback,
              coalesce(sum(n) filter (where fallback_ok), 0)::bigint as fallback_judge_success, coalesce(sum(n) filter (where path = 'moss_aware_reject'), 0)::bigint as moss_aware_reject, coalesce(sum(n) filter (where path = 'moss_force'), 0)::bigint as moss_force,
              coalesce(sum(n) filter (where path = 'empty_edits_reject'), 0)::bigint as empty_edits_reject, coalesce(sum(n) filter (where path not in ('moss_force', 'hotword_alias')), 0)::bigint as n_batched from au""",
        "pass_stats_polish": f"""with {_T}, {_V}, x as (select turn_id as k, text from v where coalesce(text, '') <> '' and e - s >= 350),
            a as (select k, case when k % 5 = 0 then 'fallback' when k % 7 = 0 then 'empty_edits_reject' when k % 3 = 0 then case when contains(text, '，') then 'llm' else 'fallback' end end as path, case when k % 2 = 0 then 'hyp' else 'meeting_draft' end as anchor from x
              where not (k % 5 <> 0 and k % 7 <> 0 and k % 3 <> 0)),
            r as (select 'n_audits' as measure, null as value from a union all select 'llm_edits', null from a where path = 'llm' union all select path, null from a where path in ('fallback', 'empty_edits_reject')
              union all select 'kind', 'punc' from a where path = 'llm' union all select 'anchor', anchor from a where path = 'llm')
            select measure, value, count(*) as n from r group by all""",
        "judgment_checks": f"""with {_I}, {_RUINED}, {_JUDGED} select infer_id, damage, coalesce(lost, head, s1) as schema_error, s2 as span_error, s3 as ladder_error,
            coalesce(lost, head, s1, case when any_a then 'pass_b_rejects_tier_a' end, s2, s4) as pass_b_error from lost left join fe using (infer_id, damage)""",
        "llm_json_extract": f"""with {_I}, a as (select infer_id, coalesce(response, '') as raw, list_filter(list_transform(regexp_extract_all(coalesce(response, ''), '{_BLOCKS}'), lambda x: {_strip("regexp_replace(x, '^<[^>]*>|</[^>]*>$', '', 'g')")}), lambda x: x <> '') as th from i),
            b as (select *, {_strip(f"regexp_replace(raw, '{_BLOCKS}', '', 'g')")} as r0 from a),
            c as (select *, regexp_replace(regexp_replace(r0, '^```(?:json|JSON)?\\s*', ''), '\\s*```$', '') as rest from b),
            d as (select *, regexp_extract(rest, '(?s)[{{].*[}}]') as o from c),
            e as (select *, case when json_valid(o) then o else nullif(regexp_extract(rest, '^[^{{]*([{{][^{{}}"]*[}}])', 1), '') end as j from d)
            select infer_id, j as json_text, coalesce(nullif(array_to_string(th, chr(10) || chr(10)), ''), case when j is not null then nullif({_strip("substring(rest, 1, instr(rest, '{') - 1)")}, '') end) as reasoning,
              case when j is null then 'no JSON object' end as error from e""",
        "polish_checks": f"""with {_I}, {_RUINED}, {_POLISHED} select infer_id, damage, coalesce(lost, phead, s1, s2) as error,
            case when coalesce(n, 0) > 0 then substring(lost.text, 1, instr(lost.text, a) - 1) || coalesce(b, '') || substring(lost.text, instr(lost.text, a) + length(a)) else coalesce(lost.text, '') end as new_text, coalesce(n, 0)::int as n_located from lost left join pf using (infer_id, damage)""",
        "moss_restore": f"""with {_T}, {_U}, {_H}, {_V}, {_MEM}, {_BY_TURN}, {_PASS_B} select turn_id, case when o and trim(coalesce(text, '')) = '' and coalesce(moss, '') <> '' then moss else text end as new_text,
            o and trim(coalesce(text, '')) = '' and coalesce(moss, '') <> '' as restored from pt""",
        "neighbor_prompt": f"with {_T}, {_U}, {_V}, {_MEM}, {_SPAN}, {_NEAR} select unit_key, prompt from near",
        "judge_prompts": f"""with {_T}, {_U}, {_H}, {_V}, {_MEM}, {_SPAN}, {_ALIAS}, {_NEAR},
            said as (select unit_key, string_agg('- ' || model || ': ' || coalesce(text, ''), chr(10) order by model) as hyps, count(distinct case when coalesce(text, '') <> '' then {_norm("text")} end) <= 1 as agree from h group by unit_key),
            words as (select to_json(list(term order by pos))::varchar as w from term),
            x as (select said.unit_key, hyps, contains_overlap as o, heavy_overlap as v, coalesce(near.prompt, '') as near from said join u using (unit_key) left join near using (unit_key) where not skip_asr and (contains_overlap or not agree))
            select unit_key, {_PROMPT} as prompt from x, words""",
        "built_units": f"""with recursive {_T}, {_V}, {_PIECES}, {_BUILT}, bu as (select *, meeting_id || '/' || unit_id as k from ub),
            hit as (select k, greatest(bu.start_ms, v.s) as a, least(bu.end_ms, v.e) as b from bu join v on bu.meeting_id = v.meeting_id and bu.speaker <> v.who and v.s < bu.end_ms and bu.start_ms < v.e),
            hw as (select *, max(b) over (partition by k order by a, b rows between unbounded preceding and 1 preceding) as m from hit),
            cov as (select k, sum(greatest(0, b - greatest(a, coalesce(m, a)))) as ms from hw group by k),
            r as (select meeting_id, unit_id, round(coalesce(ms, 0) / (end_ms - start_ms)::double, 9) as overlap_ratio from bu left join cov using (k))
            select meeting_id, unit_id, overlap_ratio, overlap_ratio > 0 as contains_overlap, overlap_ratio > 0.30 as heavy_overlap from r""",
        "turn_validation": f"""with {_T} select turn_id, meeting_id, turn_index, reason from (select *, case when start_s is null or end_s is null or not isfinite(start_s) or not isfinite(end_s) then 'nan_or_inf'
            when end_s <= start_s then 'end_le_start' when round((end_s - start_s) * 1e6) < 10000 then 'too_short_invalid' end as reason from t) where reason is not null""",
        "turn_positions": f"with {_T}, {_V} select turn_id, row_number() over (partition by meeting_id order by turn_index) - 1 as pos from v",
        "turn_status": f"""with {_T} select turn_id, coalesce(asr_status, case when {_strip("coalesce(text, '')")} <> '' then 'provisional' else 'empty' end) as asr_status, coalesce(source, 'fused') as source, coalesce(confidence, 1.0) as confidence from t""",
        "unit_split_long": f"with {_T}, {_V}, {_PIECES} select turn_id, k::int as piece, n as n_pieces, ps as start_ms, pe as end_ms from pc where n > 1",
        "unit_build": f"with recursive {_T}, {_V}, {_PIECES}, {_BUILT} select * from ub",
        "unit_short_skip": f"with {_T}, {_U}, {_V}, {_MEM}, {_SPAN} select unit_key, e - s as dur_ms, e - s < 350 as skip_asr from sp",
        "overlap_ratio": f"""with {_T}, {_V},
            hit as (select a.turn_id, greatest(a.s, b.s) as x, least(a.e, b.e) as y from v a join v b on a.meeting_id = b.meeting_id and a.who <> b.who and b.s < a.e and a.s < b.e),
            hw as (select *, max(y) over (partition by turn_id order by x, y rows between unbounded preceding and 1 preceding) as m from hit),
            c as (select turn_id, sum(greatest(0, y - greatest(x, coalesce(m, x)))) as ms from hw group by turn_id),
            r as (select v.turn_id, round(coalesce(ms, 0) / (e - s)::double, 9) as overlap_ratio from v left join c using (turn_id))
            select turn_id, overlap_ratio, overlap_ratio > 0 as contains_overlap, overlap_ratio > 0.30 as heavy_overlap from r""",
        "overlap_metadata": f"with {_U}, x as (select meeting_id, unnest(turn_indices) as turn_index, contains_overlap as o, heavy_overlap as v from u) select meeting_id, turn_index, bool_or(o) as in_overlap, bool_or(v) as in_heavy from x group by all",
        "hyp_upsert": """with a as (select unit_key, model, text, loaded_at, case when loaded_at >= timestamptz '2025-02-01 00:00:00+00' then 1 else 0 end as side from hyps),
            r as (select *, row_number() over (partition by unit_key, model order by side desc, loaded_at desc nulls last, text desc nulls last) as rn from a where model <> '' and unit_key is not null)
            select unit_key, model, text, side = 1 as is_new from r where rn = 1""",
        "agreement_gate": f"with {_H} select unit_key, count(*) as n_hyps, count(distinct case when coalesce(text, '') <> '' then {_norm('text')} end) <= 1 as agree from h group by unit_key",
        "best_hyp": f"""with {_H}, {_U}, r as (select h.unit_key, h.model, h.text, row_number() over (partition by h.unit_key order by
              case when contains_overlap and h.model = 'moss' and coalesce(h.text, '') <> '' then 0 when coalesce(h.text, '') <> '' then 1 else 2 end, h.model) as rn from h join u using (unit_key))
            select unit_key, model, text from r where rn = 1""",
        "moss_fill": f"""with {_T}, {_U}, {_H}, {_V}, {_MEM}, {_JOINED},
            miss as (select unit_key, text from jx where text <> '' and unit_key in (select unit_key from u) and unit_key not in (select unit_key from h where model = 'moss' and trim(coalesce(text, '')) <> ''))
            select unit_key, model, text, false as filled from h where not (model = 'moss' and unit_key in (select unit_key from miss)) union all select unit_key, 'moss', text, true from miss""",
        "model_gate": f"with {_U} select unit_key, unnest(case when heavy_overlap then ['moss'] else ['firered', 'moss', 'qwen'] end) as model from u where not skip_asr",
        "cache_misses": f"""with {_U}, {_H}, g as (select unit_key, unnest(case when heavy_overlap then ['moss'] else ['firered', 'moss', 'qwen'] end) as model from u where not skip_asr)
            select unit_key, model from g where not exists (select 1 from h where h.unit_key = g.unit_key and h.model = g.model and h.text <> '')""",
        "neighbors_nearest": f"""with {_T}, {_U}, {_V}, {_MEM}, {_SPAN},
            n as (select unit_key, v.turn_index, v.text, abs(sp.s + sp.e - v.s - v.e) as dist_ms2 from sp join v on sp.meeting_id = v.meeting_id and abs(sp.s + sp.e - v.s - v.e) <= 1200000
              where not exists (select 1 from mem where mem.unit_key = sp.unit_key and mem.turn_index = v.turn_index)),
            r as (select *, row_number() over (partition by unit_key order by dist_ms2, turn_index) as rank from n),
            c as (select *, sum(length(coalesce(text, '')) + 32) over (partition by unit_key order by rank) as used from r where rank <= 20)
            select unit_key, rank, turn_index, dist_ms2 from c where rank = 1 or used <= 8192""",
        "neighbors_capped": f"""with {_T}, {_V}, p as (select meeting_id, text, row_number() over (partition by meeting_id order by turn_index) - 1 as pos from v),
            n as (select a.meeting_id, a.pos, b.pos as bp, row_number() over (partition by a.meeting_id, a.pos order by b.pos) as rank, sum(length(coalesce(b.text, '')) + 32) over (partition by a.meeting_id, a.pos order by b.pos) as used
              from p a join p b on a.meeting_id = b.meeting_id and a.pos <> b.pos and b.pos <= 20),
            k as (select meeting_id, pos, count(*) as n, max(bp) as last_pos from n where rank <= 20 and (rank = 1 or used <= 8192) group by all)
            select p.meeting_id, p.pos, coalesce(n, 0) as n_neighbors, last_pos from p left join k on p.meeting_id = k.meeting_id and p.pos = k.pos""",
        "join_turn_texts": f"with {_T}, {_U}, {_V}, {_MEM}, {_JOINED} select unit_key, text, n > 1 as moss_merged from jx",
        "hyps_by_turn": f"with {_T}, {_U}, {_H}, {_V}, {_MEM}, {_BY_TURN} select unit_key, turn_index, model, text from bt",
        "hotword_load": f"with {_ALIAS} select pos, term from term",
        "hotword_aliases": f"""with {_ALIAS}, ok as (select * from al where abs(length(alt) - length(canon)) <= 1)
            select alt, max_by(canon, pos * 1000 + k) as canon, min_by(pos, pos * 1000 + k) as pos from ok group by alt""",
        "hotword_recurrence": f"with {_T}, {_ALIAS}, c as (select distinct string_split(term, '|')[1] as canon from term) select canon, exists (select 1 from t where contains(t.text, c.canon)) as recurs from c where canon <> ''",
        "audit_replace": f"with {_I} select pass, infer_id, unit_id from i where pass is distinct from 'polish' union all select 'polish', infer_id, unit_id from i where pass = 'polish' and error is null",
        "batch_summary": f"with {_I} select pass, count(*) filter (where ok) as n_ok, count(*) filter (where not ok) as n_error, count(*) filter (where ok is null) as n_null from i group by pass",
        "discovery_pairs": "select dataset, stem from meetings m where exists (select 1 from documents d where d.doc_kind = 'minutes' and d.meeting_id = m.dataset || '/' || m.stem)",
        "discovery_skips": "select dataset, stem, 'missing_mode_c' as reason from meetings m where not exists (select 1 from documents d where d.doc_kind = 'minutes' and d.meeting_id = m.dataset || '/' || m.stem)",
        "p6_found": f"with {_T}, {_V}, {_REACH} select meeting_id, m as gap_start_ms, s as gap_end_ms from w where s > m",
        "p6_periods": f"""with {_T}, {_V}, {_REACH},
            x as (select *, sum(case when m is null or s > m then 1 else 0 end) over (partition by meeting_id order by s, e rows unbounded preceding) as k from w)
            select meeting_id, min(s) as period_start_ms, max(e) as period_end_ms, count(*) as n_rows from x group by meeting_id, k""",
        "p6_overlap": f"""with {_T}, {_U}, {_V},
            mu as (select unit_key, meeting_id, {_label("speaker_id")} as who, unnest(list_distinct(turn_indices)) as turn_index from u),
            sp as (select unit_key, mu.meeting_id, mu.who, min(s) as s, max(e) as e from mu join v on mu.meeting_id = v.meeting_id and mu.turn_index = v.turn_index group by all),
            hit as (select unit_key, greatest(sp.s, v.s) as a, least(sp.e, v.e) as b from sp join v on sp.meeting_id = v.meeting_id and sp.who <> v.who and v.s < sp.e and sp.s < v.e),
            hw as (select *, max(b) over (partition by unit_key order by a, b rows between unbounded preceding and 1 preceding) as m from hit),
            cov as (select unit_key, sum(greatest(0, b - greatest(a, coalesce(m, a)))) as ms from hw group by unit_key)
            select sp.unit_key, round(coalesce(ms, 0) / (sp.e - sp.s)::double, 9) as overlap_ratio from sp left join cov using (unit_key)""",
    }
