"""Equivalent SQL for those training-data queries that SQL can express on whole tables."""

from __future__ import annotations

from turnloom.functions.text import width_pairs

# Stems of words for noises, and letters that look like Latin ones, kept apart from the operator's own lists.
SOUND_EN = "laugh|cough|sneez|sniff|sigh|breath|yawn|music|applau|clap|nois|static|silen|inaudible|unintelligible|crosstalk|ring|beep|knock|door|typing|keyboard|background|pause|throat|phone|footstep|click|hum|chuckl"
SOUND_ZH = "笑|咳|静音|静默|沉默|无声|音乐|掌声|鼓掌|敲门|关门|开门|门声|噪音|噪声|杂音|呼吸|叹气|喷嚏|铃声|电话响|听不清|脚步|背景音|键盘|清嗓"
_LIKE, _LATIN = "аеорсухіѕАВЕМНОРСТХЅІΑΒΕΗΜΝΟΡΤΧΥΖ", "aeopcyxisABEMHOPCTXSIABEHMNOPTXYZ"

_TURNS = "t as (select * from (select *, row_number() over (partition by turn_id order by loaded_at desc) as rn from turns) where rn = 1)"
_UNITS = "u as (select * from (select *, row_number() over (partition by unit_key order by loaded_at desc) as rn from units) where rn = 1)"
_LONG = (
    "(?i)(too|over|very)[\\s_-]*(long|cap|limit|length|size|duration)|exceed|long(er)?[\\s_-]*than|(>|above|beyond)\\s*(the\\s*)?(max|cap|limit|[0-9])|max[a-z]*[\\s_-]*(dur|len)"
    "|(dur|len)[a-z]*[\\s_-]*(cap|limit|max)|oversize|超长|过长|太长|超时|超限|超出|超过"
)

P4_FOUND = f"""
with recursive {_TURNS}, {_UNITS},
m as (select unit_key, meeting_id, unnest(list_distinct(turn_indices)) as turn_index from u
      where trim(coalesce(skip_reason, '')) = '' or regexp_matches(trim(skip_reason), '{_LONG}')),
k as (select m.unit_key, cast(round(t.start_s * 1000) as bigint) as s, cast(round(t.end_s * 1000) as bigint) as e
      from m join t on m.meeting_id = t.meeting_id and m.turn_index = t.turn_index
      where isfinite(t.start_s) and isfinite(t.end_s) and t.end_s > t.start_s),
w as (select *, max(e) over (partition by unit_key order by s, e rows between unbounded preceding and 1 preceding) as top from k),
span as (select unit_key, min(s) as s, max(e) as e from k group by unit_key having max(e) - min(s) > 30000),
pause as (select unit_key, top as a, s as b from w where s - top >= 300),
cuts as (
  select unit_key, s as at, e, true as in_pause from span
  union all
  select c.unit_key, coalesce((select max(least(p.b, c.at + 30000)) from pause p where p.unit_key = c.unit_key and p.a <= c.at + 30000 and least(p.b, c.at + 30000) - 1000 > c.at), c.at + 30000) - 1000 as at, c.e,
         exists (select 1 from pause p where p.unit_key = c.unit_key and p.a <= c.at + 30000 and least(p.b, c.at + 30000) - 1000 > c.at) as in_pause
  from cuts c where c.e - c.at > 30000)
select unit_key, case when bool_and(in_pause) then 'natural' else 'forced' end as cut from cuts group by unit_key
"""

_INV = "\\x{ad}\\x{34f}\\x{61c}\\x{180e}\\x{200b}-\\x{200f}\\x{202a}-\\x{202e}\\x{2060}-\\x{2064}\\x{2066}-\\x{206f}\\x{feff}"
_SPACES = "\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000}"
_CLOCK = "[0-9]{1,4}:[0-5]?[0-9](:[0-5]?[0-9])?([.,][0-9]{1,6})?"
_STAMP = "[0-9]{1,3}:[0-5][0-9]:[0-5][0-9]([.,][0-9]{1,6})?"
_OPEN, _SHUT = "[\\[【〔<({（]", "[\\]】〕>)}）]"
_TIME = (
    f"{_CLOCK}\\s*-{{1,2}}>\\s*{_CLOCK}|{_OPEN}\\s*{_CLOCK}(\\s*[-–~]+>?\\s*{_CLOCK})?\\s*/?\\s*{_SHUT}|{_CLOCK}\\s*\\||[<\\[{{(]\\s*(t|time|ts)\\s*[=:]\\s*[0-9]+(\\.[0-9]+)?\\s*s?\\s*/?[>\\]}})]"
    f"|[{{\\[<(]\\s*[0-9]+(\\.[0-9]+)?\\s*s\\s*[}}\\]>)]|{_STAMP}"
)
_BODY = f"(([\\p{{L}}-]+\\s+){{0,2}}({SOUND_EN})[\\p{{L}}-]*(\\s+[\\p{{L}}-]+){{0,2}}|\\p{{Han}}{{0,4}}({SOUND_ZH})\\p{{Han}}{{0,3}})"
_SOUND = f"(?i){_OPEN}{{1,2}}\\s*{_BODY}\\s*{_SHUT}{{1,2}}|\\*{{1,2}}\\s*{_BODY}\\s*\\*{{1,2}}|[♩♪♫♬]+"
_LABEL = f"(?im)^[\\s>|–—,，.。、…-]*((speaker|spk|s|发言人|说话人)[\\s_-]*[0-9]+\\s*[:：>]+|{_OPEN}(speaker|spk|s|发言人|说话人)[\\s_-]*[0-9]+{_SHUT}\\s*[:：]?)"
_FILLER = "(?i)(^|[^\\p{L}\\p{N}\\p{M}''’])(u+h+m*|u+m+|h+m+|m{2,}|e+rm*|[嗯呃额唔]+)($|[^\\p{L}\\p{N}\\p{M}''’])"
_FROM, _TO = width_pairs()

P3_FOUND = f"""
with {_TURNS},
a as (select turn_id, speaker_id, translate(regexp_replace(regexp_replace(coalesce(text, ''), '[{_INV}]', '', 'g'), '[{_SPACES}]', ' ', 'g'), '{_FROM}', '{_TO}') as x0,
  translate(regexp_replace(regexp_replace(speaker_id, '[{_INV}]', '', 'g'), '[{_SPACES}]', ' ', 'g'), '{_FROM}', '{_TO}') as sp from t),
b as (select *, regexp_replace(x0, '{_TIME}', ' ', 'g') as x1 from a),
c as (select *, regexp_replace(x1, '{_SOUND}', ' ', 'g') as x2 from b),
d as (select *, regexp_replace(x2, '{_LABEL}', ' ', 'g') as x3,
  coalesce('speaker_' || nullif(regexp_extract(sp, '(?i)^[^\\pL\\pN]*(speaker|spk|s|发言人|说话人)[\\s_-]*0*([0-9]+)[^\\pL\\pN]*$', 2), ''), 'unknown') as speaker from c)
select turn_id, unnest(list_filter([case when x1 <> x0 then 'timestamp' end, case when regexp_matches(translate(x3, '{_LIKE}', '{_LATIN}'), '{_FILLER}') then 'filler' end, case when x2 <> x1 then 'sound' end,
  case when x3 <> x2 or not regexp_full_match(coalesce(speaker_id, ''), 'speaker_(0|[1-9][0-9]*)') then 'label' end], lambda k: k is not null)) as dirt, speaker from d
"""

_EMO = "\\x{1f000}-\\x{1faff}\\x{2600}-\\x{27bf}\\x{2190}-\\x{21ff}\\x{2300}-\\x{23ff}\\x{2b00}-\\x{2bff}"
P5_FOUND = f"""
with x as (select 'turns' as tbl, turn_id as row_id, text from turns union all select 'hyps', hyp_id, text from hyps),
y as (select tbl, row_id, regexp_replace(text, '[{_EMO}](\\x{{fe0f}}|[\\x{{1f3fb}}-\\x{{1f3ff}}]|\\x{{200d}}[{_EMO}])*', '☻', 'g') as s from x where row_id is not null)
select distinct tbl, row_id from y where regexp_matches(s, '[{_INV}{_SPACES}\\x{{fe00}}-\\x{{fe0f}}\\x{{300}}-\\x{{36f}}\\x{{3099}}\\x{{309a}}\\x{{1100}}-\\x{{11ff}}\\x{{ff10}}-\\x{{ff19}}\\x{{ff21}}-\\x{{ff3a}}\\x{{ff41}}-\\x{{ff5a}}\\x{{2e80}}-\\x{{2fdf}}\\x{{f900}}-\\x{{faff}}\\x{{fb00}}-\\x{{fb06}}]')
  or regexp_matches(s, '\\p{{Latin}}[\\p{{Cyrillic}}\\p{{Greek}}]|[\\p{{Cyrillic}}\\p{{Greek}}]\\p{{Latin}}')
"""

_WINDOWS = """w as (select doc_id, i, hash(substring(text, i, 300)) as h from (select doc_id, text, unnest(range(1, length(text) - 298)) as i from documents where length(text) >= 300)),
r as (select h from w group by h having min(doc_id) < max(doc_id)), x as (select doc_id, i, h from w where h in (select h from r))"""
P9_FOUND = f"with {_WINDOWS} select distinct a.doc_id as doc_a, b.doc_id as doc_b from (select distinct doc_id, h from x) a join (select distinct doc_id, h from x) b on a.h = b.h and a.doc_id < b.doc_id"
P9_LINKS = f"""with {_WINDOWS}, c as (select doc_id, min(doc_id) over (partition by text) as class_id from documents where length(text) >= 300),
p as ({{P9_FOUND}}), q as (select a.class_id as a, b.class_id as b from p join c a on a.doc_id = doc_a join c b on b.doc_id = doc_b where a.class_id <> b.class_id)
select distinct least(a, b) as doc_a, greatest(a, b) as doc_b from q union all select class_id, doc_id from c where class_id <> doc_id"""
P9_LINKS = P9_LINKS.replace("{P9_FOUND}", P9_FOUND.split(_WINDOWS)[1])
P9_SPANS = f"""with {_WINDOWS}, g as (select doc_id, i, lag(i) over (partition by doc_id order by i) as p from x),
k as (select doc_id, i, sum(case when p is null or i - p > 300 then 1 else 0 end) over (partition by doc_id order by i rows unbounded preceding) as n from g)
select doc_id, min(i)::int - 1 as "start", max(i)::int + 299 as "end" from k group by doc_id, n"""
P9_CLASSES = "select doc_id, min(doc_id) over (partition by text) as class_id from documents where length(text) >= 300 qualify count(*) over (partition by text) > 1"
P9_SHARED = f"""with {_WINDOWS}, g as (select doc_id, i, lag(i) over (partition by doc_id order by i) as p from x),
c as (select doc_id, sum(least(300, i - coalesce(p, i - 300))) as n from g group by doc_id)
select d.doc_id, length(text) as n_chars, coalesce(n, 0) as shared_chars, round(coalesce(n, 0) / length(text)::double, 6) as share from documents d left join c using (doc_id) where length(text) > 0"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {"p3_found": P3_FOUND, "p4_found": P4_FOUND, "p5_found": P5_FOUND, "p9_found": P9_FOUND, "p9_links": P9_LINKS, "p9_spans": P9_SPANS, "p9_classes": P9_CLASSES, "p9_shared": P9_SHARED}
