"""Defective prompt and response pairs.

Each reply is read by one pushdown parser (``reply_parser``: think blocks, fences, JSON, brackets, quotations, emphasis,
lists, markup) that says whether it broke off and where its payload lies. Greedy string tiling of the payload against the instruction finds copied prompts,
refusal grammars find declined tasks, and script and function-word checks find replies in another language.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.reply_parser import breaks_off, parse_reply
from turnloom.llm.shared_spans import _mix, _powers

# Replies that stand for nothing.
PLACEHOLDERS = {"", "null", "none", "nil", "n/a", "na", "nan", "undefined", "tbd", "todo", "empty", "no response", "no answer", "无", "空", "暂无", "待定", "略"}
CLOSING = ".。!！?？…\"”’'」』》)）】]}›»;；`*~♪"

# Frequent function words that tell the Latin-script languages apart.
FUNCTION_WORDS = {
    "en": "the of and to is was in on it that for with at by this be are as from we you not or an have has were will can if because before after which than into over once unless since while there them they its so do does my your our i",
    "es": "el la los las de del y que en un una es por con para no se su al lo como más pero sobre este esta está hay fue son muy mañana ya o si porque cuando",
    "fr": "le la les des du de et est en un une que qui dans pour pas sur au aux avec ce cette il elle nous vous sont être a ont mais ou plus par ne je se l d qu c n s",
    "de": "der die das und ist in von zu den dem mit nicht ein eine einen auf für im sich auch es an werden aus er hat dass sie nach wird bei um noch am wie oder weil erst wir ich kann fertig",
    "it": "il lo la gli le di del della e che in un una è per con non si da sono al più come ma anche questo questa ha nel alla dei delle",
    "pt": "o a os as de do da e que em um uma é por com para não se no na ao mais como mas foi dos das está são pelo pela isso amanhã",
    "nl": "de het een en van in is dat op te zijn met voor niet aan er om ook als bij maar uit naar dan nog wel wordt",
}
WORD_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}

# Refusal grammars. The object is the assistant's own task, never something a speaker of a meeting declines.
_TASK_EN = r"(?:help|assist|process|translat|edit|correct|answer|handl|choos|decid|judg|provid|complet|compl(?:y|ies)|continue|fulfil|summar|comment|engage|support|discuss|review|generat|creat|produc|respond|do (?:this|that)|take (?:this|that|on|part))"
REFUSALS = [
    rf"\bi(?:'m| am)? (?:sorry|afraid|unable|not able)[^.!?]{{0,60}}?\b(?:can ?not|can't|won't|will not|unable to|not able to|am not able to|'m not able to|must decline to)\s+{_TASK_EN}",
    rf"\b(?:i|we) (?:can ?not|can't|won't|will not|am unable to|'m unable to|am not able to|'m not able to|am not allowed to|must decline|have to decline|would rather not|decline to|must refuse|refuse to)\b(?: to)? {_TASK_EN}",
    r"\b(?:as an? (?:ai|assistant|language model|artificial)|my (?:policy|policies|guidelines|instructions|rules|programming) (?:do(?:es)? not|don't|doesn't|prevent|forbid|prohibit))",
    r"\bwould(?: not|n't) be (?:appropriate|right|proper|possible) for me\b",
    r"\b(?:request|task) (?:is|was|has been|must be) (?:declined|refused|denied|rejected)\b",
    r"\bno answer can be given\b|\b(?:outside|beyond) (?:of )?(?:my|what i)\b|\b(?:goes|is) against my\b|\bagainst (?:my|the) (?:guidelines|policy|policies)\b",
    r"\b(?:not|isn't) something (?:that )?i(?:'m| am)? (?:can|could|able|allowed|permitted|willing)|\bi have to pass on\b|\bi (?:don't|do not) (?:answer|help|assist|handle|translate|edit|process|feel comfortable)|\bplease consult (?:a|an|the)\b",
    r"\bnot (?:permitted|allowed|able|authori[sz]ed) to (?:help|assist|process|translate|edit|correct|answer|handle|choose|judge|take|provide)",
    r"(?:不能|无法|不便|不可以|不会|没有办法|没办法|没有权限|无权|不方便|拒绝|谢绝|难以|恕不能)(?:再|继续|为您|为你|帮您|帮你|直接)?(?:协助|处理|翻译|判断|修改|回答|在候选中|提供|完成|参与|评论|帮助|满足|改写|润色|选择|讨论|继续|总结|概括|回应|执行|给出)",
    r"\bunable to (?:comply|help|assist|process|provide|complete|fulfil)|\b(?:not|n't feel) comfortable (?:with|doing|help|answer|translat)|\bi (?:can ?not|can't|won't) do (?:that|this)\b",
    r"我(?:不能|无法|不会)(?:这样|这么|那样|照)做|请恕|不予(?:处理|回答|翻译)|爱莫能助|无法为[您你]|恕难从命|超出了?我的|不在我(?:可以|能够|能)?(?:处理|帮助|回答|协助)?的?(?:范围|能力)|无可奉告|作为(?:一个|一名)?(?:人工智能|AI|ai|语言模型|助手)|违反(?:了)?(?:我的|相关|内容)?(?:准则|政策|规定)|这个请求我(?:无法|不能)|无法(?:完成|满足)(?:这个|该|您的|你的)?(?:请求|任务)",
    r"\b(?:lo siento|lamento|me temo|disculpe?)\b[^.!?]{0,80}\bno (?:puedo|puede|es posible|me es posible|estoy)|\bno puedo (?:ayudar|asistir|traducir|procesar|responder|corregir|editar|elegir|atender|realizar|completar|continuar)|\bcomo (?:asistente|modelo|ia)\b|\bno (?:me )?(?:está|esta) permitido|\bfuera de mi",
    r"\b(?:désolée?|navrée?|regrette|malheureusement|excusez)\b[^.!?]{0,80}\bne (?:peux|puis|suis|pouvons)|\bje ne (?:peux|puis|suis) pas (?:aider|vous aider|traduire|traiter|répondre|corriger|en mesure|autorisée?|choisir|modifier)|\ben tant qu(?:e |')(?:assistant|ia|modèle|intelligence)",
    r"\b(?:tut mir leid|leider|entschuldig\w*|bedaure|es tut mir)\b[^.!?]{0,80}\b(?:kann|darf|möchte|werde) (?:ich )?[^.!?]{0,80}\b(?:nicht|nichts|keine?n?)\b|\b(?:kann|darf) ich (?:ihnen |dir |dabei |das |diese[nrs]? |hier )*(?:leider )?nicht\b|\bals (?:assistent|ki|sprachmodell)\b|\bich (?:kann|darf) (?:\w+ ){0,4}nicht (?:helfen|übersetzen|bearbeiten|beantworten|korrigieren|weiterhelfen)",
    r"\b(?:mi dispiace|spiacente)\b|\bnon posso (?:aiutar|tradurre|elaborare|rispondere|correggere|assister)|\b(?:desculpe|lamento|sinto muito)\b[^.!?]{0,80}\bnão (?:posso|consigo)|\bnão posso (?:ajudar|traduzir|processar|responder|corrigir)",
    r"(?:できません|出来ません|致しかね|いたしかね|お断り|対応しかね|お手伝いでき|お答えでき|お応えでき|ご遠慮)|(?:할 수 없습니다|도와드릴 수 없|어렵습니다|거절|불가능합니다|도움을 드릴 수 없)",
    r"(?:извините|простите|к сожалению)[^.!?]{0,80}не (?:могу|можем|имею)|\bне могу (?:помочь|перевести|обработать|ответить|исправить|выполнить)|я не (?:могу|вправе)",
]
REFUSAL = re.compile("|".join(f"(?:{r})" for r in REFUSALS), re.I)

# Names of the languages that ``language`` knows, in English, Chinese and the language itself.
LANGUAGES = {
    "en": "english|英文|英语|anglais|englisch|inglés|inglese|inglês|английский", "zh": "chinese|mandarin|中文|汉语|普通话|chinois|chinesisch|chino|cinese|китайский", "fr": "french|法文|法语|français|französisch|francés|francese",
    "de": "german|德文|德语|deutsch|allemand|alemán|tedesco", "es": "spanish|西班牙文|西班牙语|español|espagnol|spanisch", "it": "italian|意大利文|意大利语|italiano|italien|italienisch", "pt": "portuguese|葡萄牙文|葡萄牙语|português|portugais",
    "nl": "dutch|荷兰文|荷兰语|nederlands|néerlandais", "ja": "japanese|日文|日语|日本語|japonais|japanisch|japonés", "ko": "korean|韩文|韩语|한국어|coréen|koreanisch|coreano", "ru": "russian|俄文|俄语|русский|russe|russisch|ruso", "el": "greek|希腊文|希腊语|ελληνικά|grec", "ar": "arabic|阿拉伯文|阿拉伯语|العربية|arabe",
}
TARGETS = [
    (k, re.compile(rf"\b(?:into|to|in|an?|faithful|ins?|en|au|al|in het|na|на)\s+(?:{names})\b|(?:{names})\s+(?:version|translation|rendering)|(?:译|翻译|译写)(?:成|为|到)\s*(?:{names})|(?:用|以)\s*(?:{names})|(?:{names})に|(?:{names})로", re.I))
    for k, names in LANGUAGES.items()
]


def target_language(question: str) -> str | None:
    """The language an instruction asks for; of several the one named last, as in 'from German into French'."""
    named = [(m.start(), k) for k, p in TARGETS for m in p.finditer(question)]
    return max(named)[1] if named else next((k for k, names in LANGUAGES.items() if k in ("en", "zh") and re.search(names, question, re.I)), None)


def tokens(text: str) -> list[str]:
    """Words of alphabetic scripts, single Han, kana and Hangul characters, digits runs; case and width folded."""
    return re.findall(r"[一-鿿㐀-䶿぀-ヿ가-힯]|\d+|[^\W\d_一-鿿㐀-䶿぀-ヿ가-힯]+", unicodedata.normalize("NFKC", text).lower())


class _Runs:
    """Token numbers of a text with prefix hashes and marks of what is used."""

    def __init__(self, ids: list[int], powers: tuple[np.ndarray, np.ndarray]):
        self.n, self.up = len(ids), powers[0]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(np.array(ids, np.uint64)) * powers[1][: len(ids)])])
        self.free, self.all_free = np.ones(len(ids), bool), True

    def windows(self, size: int) -> tuple[list[int], list[int]]:
        """Starts and hashes of the windows of ``size`` tokens that are all free."""
        at = np.arange(self.n - size + 1)
        if not self.all_free:
            used = np.concatenate([[0], np.cumsum(~self.free)])
            at = np.flatnonzero(used[size:] == used[: len(at)])
        return at.tolist(), ((self.sums[at + size] - self.sums[at]) * self.up[at + size]).tolist()

    def open(self, at: int, size: int) -> bool:
        return self.all_free or bool(self.free[at : at + size].all())

    def mark(self, at: int, size: int) -> None:
        self.free[at : at + size], self.all_free = False, False


def tile(a: list[str], b: list[str], least: int) -> int:
    """Tokens of ``a`` covered by greedy string tiling with ``b``, each token used once.

    Runs are searched by hash in falling lengths, from the whole of the shorter text down to ``least``; a run that is
    found goes on as far as both texts agree. Each length is one linear pass, and there are logarithmically many.
    """
    if len(a) < least or len(b) < least:
        return 0
    grams = {tuple(b[j : j + least]) for j in range(len(b) - least + 1)}
    if not any(tuple(a[i : i + least]) in grams for i in range(len(a) - least + 1)):
        return 0
    number: dict[str, int] = {}
    powers = _powers(1 << max(20, max(len(a), len(b)).bit_length()))
    x, y = (_Runs([number.setdefault(t, len(number) + 1) for t in ts], powers) for ts in (a, b))
    size = min(len(a), len(b))
    while True:
        (at_a, h_a), (at_b, h_b) = x.windows(size), y.windows(size)
        common = set(h_a) & set(h_b)
        if common:
            places: dict[int, list[int]] = {}
            for j, h in zip(reversed(at_b), reversed(h_b)):
                if h in common:
                    places.setdefault(h, []).append(j)  # the first place is the last of the list
            upto = 0
            for i, h in zip(at_a, h_a):
                if i < upto or h not in common or not x.open(i, size):
                    continue
                open_places = places[h]
                while open_places and not y.open(open_places[-1], size):
                    open_places.pop()
                if not open_places:
                    continue
                j, k = open_places.pop(), size
                while i + k < len(a) and j + k < len(b) and x.free[i + k] and y.free[j + k] and a[i + k] == b[j + k]:
                    k += 1
                x.mark(i, k)
                y.mark(j, k)
                upto = i + k
        if size == least or len(a) - int((~x.free).sum()) < least:
            return int((~x.free).sum())
        size = max(least, size * 2 // 3)


_LATIN = re.compile(r"[A-Za-z]")
_LETTER = re.compile(r"[^\W\d_]+")
_SCRIPTS = [re.compile(f"[{r}]+") for r in ("一-鿿㐀-䶿", "ぁ-ゖァ-ヺー", "가-힯ᄀ-ᇿ", "Ѐ-ԯ", "Ͱ-Ͽ", "ء-ي")]


def language(text: str) -> str | None:
    """zh, ja, ko, ru, el, ar or a Latin-script language; null where the text doesn't tell."""
    if text.isascii():
        han = kana = hangul = cyr = greek = arab = 0
        latin = len(_LATIN.findall(text))
    else:
        han, kana, hangul, cyr, greek, arab = (sum(map(len, p.findall(text))) for p in _SCRIPTS)
        latin = sum(map(len, _LETTER.findall(text))) - han - kana - hangul - cyr - greek - arab
    total = han + kana + hangul + cyr + greek + arab + latin
    if not total:
        return None
    words = re.findall(r"[^\W\d_]+", text.lower())
    scores = {k: sum(w in s for w in words) for k, s in WORD_SETS.items()}
    if kana and kana >= 0.35 * (kana + han) and kana + han > 0.5 * total:
        return "ja"
    if hangul > 0.35 * total:
        return "ko"
    if cyr > 0.5 * total:
        return "ru"
    if greek > 0.5 * total:
        return "el"
    if arab > 0.5 * total:
        return "ar"
    if han >= 4 and han * 3 >= latin * 0.6 and han * 5 > latin:
        return "zh"
    if han and han * 4 >= latin and max(scores.values()) < 2:
        return "zh"
    best = max(scores.values())
    if latin and best >= 1:
        top = [k for k, v in scores.items() if v == best]
        return "en" if "en" in top else top[0]
    return "zh" if han else None


def split_prompt(kind: str, user: str) -> tuple[str, str, list[str]]:
    """Instruction or question, material, and the single hypotheses or drafts of a prompt."""
    if kind == "minutes":
        head, _, rest = user.partition("\n")
        question = re.sub(r"^\s*[^:：\n]{1,12}[:：]\s*", "", head)
        return question, rest, []
    if kind == "translate":
        head, _, rest = user.partition("\n\n") if "\n\n" in user else user.partition("\n")
        return head, rest, [rest.strip()]
    lines, instruction, hyps, material = user.split("\n"), [], [], []
    seen = False
    for ln in lines:
        m = re.match(r"\s*(?:-\s*[\w.-]+|draft|草稿)\s*[:：]\s*(.*)$", ln, re.I)
        if m:
            seen = True
            hyps.append(m.group(1).strip())
            material.append(ln)
        elif not seen and not re.match(r"\s*#+ |\s*$|\s*[\w ]+[:：]\s*$", ln):
            instruction.append(ln)
        else:
            material.append(ln)
    return "\n".join(instruction), "\n".join(material), [h for h in hyps if h]


def defect(kind: str | None, user: str | None, reply: str | None) -> str | None:
    """The first of empty, truncated, refusal, copied_prompt, wrong_language that fits, else null.

    A null or blank reply is empty; a null prompt leaves only the checks that need none; an unknown kind is read as a
    translation without a target. Whole texts are read.
    """
    user, kind = user or "", (kind or "").strip().lower()
    text = (reply or "").strip(" \t\r\n 　​﻿")
    if text.strip("\"'`“”.。…-—_ \n[]{}()").lower() in PLACEHOLDERS:
        return "empty"
    p = parse_reply(text)
    if not p.broken and p.payload is not None and p.payload.strip(" \t\r\n 　​﻿\"'`“”.。…-—_[]{}()").lower() in PLACEHOLDERS:
        return "empty"
    if p.broken and not (p.payload and not p.is_json and _copied(kind, user, p.payload)):
        return "truncated"
    body = p.payload or ""
    if kind in ("judge", "polish") and p.is_json and len(body) > 1 and f": {body}\n" in user + "\n":
        return None  # a hypothesis or the draft word for word
    if not p.is_json:
        if _copied(kind, user, body):
            return "refusal" if REFUSAL.search(body) and not REFUSAL.search(user) else "copied_prompt"
        if breaks_off(p, CLOSING):
            return "truncated"
    question, material, hyps = split_prompt(kind, user)
    body_t = tokens(body)
    near = kind in ("judge", "polish") and bool(body_t) and max((tile(body_t, tokens(h), min(3, len(body_t))) for h in hyps), default=0) >= 0.5 * len(body_t)
    refusing = REFUSAL.search(body) if not near else None
    if refusing and not (kind == "translate" and REFUSAL.search(material)):
        return "refusal"
    if p.is_json and _copied(kind, user, body):
        return "copied_prompt"
    return None if near else _wrong_language(kind, question, material, hyps, body, body_t)


def _copied(kind: str, user: str, body: str) -> bool:
    question, _, hyps = split_prompt(kind, user)
    q, b = tokens(question), tokens(body)
    if len(q) < 3 or len(b) < 3 or any(b == tokens(h) for h in hyps):
        return False
    least = min(5, len(q))
    grams = {tuple(q[i : i + least]) for i in range(len(q) - least + 1)}
    if not any(tuple(b[i : i + least]) in grams for i in range(len(b) - least + 1)):
        return False
    times = max(1, round(len(b) / max(1, len(q))))
    if tile(b, q * times, least) >= 0.7 * len(b):
        return True
    return tile(q, b, least) >= 0.8 * len(q) and tile(b, tokens(user) * max(1, round(len(b) / max(1, len(tokens(user))))), 3) >= 0.8 * len(b)


def _wrong_language(kind: str, question: str, material: str, hyps: list[str], body: str, body_t: list[str]) -> str | None:
    got = language(body)
    if got is None or not body_t:
        return None
    if kind in ("judge", "polish"):
        want = {language(s) for h in hyps for s in [h, *re.split(r"(?<=[。！？.!?])\s*", h)]} - {None}
        return "wrong_language" if want and got not in want else None
    if kind == "minutes":
        want = language(question)
        return "wrong_language" if want and got != want else None
    if kind == "translate":
        target = target_language(question)
        return "wrong_language" if target and got != target else None
    return None


def found_defects(current: DataFrame) -> DataFrame:
    """(infer_id, defect): one row per defective pair of the current rows."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            kinds = [defect(k, u, r) for k, u, r in zip(pdf["pass"], pdf["user_text"], pdf["response"])]
            out = pd.DataFrame({"infer_id": pdf["infer_id"].astype("int64"), "defect": kinds})
            yield out[out["defect"].notna()]

    return current.where(F.col("infer_id").isNotNull()).select("infer_id", "pass", "user_text", "response").mapInPandas(judge, "infer_id bigint, defect string")
