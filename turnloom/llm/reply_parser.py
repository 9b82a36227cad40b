"""A pushdown parser for replies of models.

One scan over a reply keeps a stack of everything that is open: think blocks, fences (character and length), JSON
values, brackets of all kinds, quotations, emphasis, inline code and markup elements. What the stack still holds at the
end broke off; so did an empty list item. Inside a think block only its end counts, inside a fence only the fence's end
and JSON.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

# Pairs of brackets and quotation marks, and the elements of markup that need an end.
PAIRS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "【": "】", "〔": "〕", "《": "》", "〈": "〉", "「": "」", "『": "』", "“": "”"}
ELEMENTS = frozenset("a b i u s em strong code pre p div span ul ol li dl dt dd table thead tbody tr td th h1 h2 h3 h4 h5 h6 blockquote html body head section article sub sup small details summary".split())
OPTIONAL_END = frozenset("p li dt dd tr td th thead tbody".split())

_SHUT = {b: a for a, b in PAIRS.items()}
_LEX = re.compile(
    r"(?P<think><\s*(?P<endthink>/?)\s*(?:think|thinking|reasoning|thought)\s*>)"
    r"|^[ \t]*(?P<fence>`{3,}|~{3,})(?P<info>[^\n`]*)$"
    r"|(?P<interval>[\[(]\s*-?\d[\d.]*\s*[,;，]\s*-?\d[\d.]*\s*[\])])"
    r"|<(?P<endtag>/?)(?P<tag>[A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*?)?(?P<selfend>/?)>"
    r"|(?P<item>^[ \t]*(?:[-*•+]|\d{1,3}[.)、．])[ \t]*$)"
    r"|(?P<listed>^[ \t]*(?:[-*•+]|\d{1,3}[.)、．])[ \t]+(?=\S))"
    r"|(?P<bold>\*\*+(?=\S)|(?<=\S)\*\*+|__(?=\w)|(?<=\w)__)|(?P<code>`+)|(?P<quote>\")"
    rf"|(?P<open>[{re.escape(''.join(PAIRS))}])|(?P<shut>[{re.escape(''.join(_SHUT))}])",
    re.M | re.I,
)
_THINK = re.compile(r"<\s*(/?)\s*(?:think|thinking|reasoning|thought)\s*>", re.I)
_JSON_HEAD = re.compile(r"\{\s*(?:\"|\}|\Z)|\[\s*(?:[{\"\]]|\Z)")
_WHOLE_END = re.compile(r"(?:https?://|www\.)[^\s<>\"，。；]+\Z|</[a-z][a-z0-9]*>\Z", re.I)


@dataclass
class Parsed:
    """What the parser saw: whether a block or JSON broke off, the text outside think blocks and fence lines, the payload
    (a JSON reply's text, else the body), whether it is JSON, what plain marks stay open, and whether it ends in a list item."""

    broken: bool
    body: str
    payload: str | None
    is_json: bool
    left_open: list[str] = field(default_factory=list)
    list_end: bool = False


def json_end(s: str, at: int) -> int | None:
    """The end of the JSON value that begins at ``at``; null where its stack doesn't empty."""
    stack, i, n = [], at, len(s)
    while i < n:
        ch = s[i]
        if stack and stack[-1] == '"':
            if ch == "\\":
                i += 1
            elif ch == '"':
                stack.pop()
        elif ch == '"':
            stack.append('"')
        elif ch in "{[":
            stack.append("}" if ch == "{" else "]")
        elif ch in "}]":
            if not stack or stack[-1] != ch:
                return None
            stack.pop()
            if not stack:
                return i + 1
        i += 1
    return None


def text_of(value: object) -> str:
    """The answer a JSON reply holds: its text field, else its only string, else all strings joined."""
    if isinstance(value, dict):
        for k in ("text", "answer", "translation", "summary", "content", "output", "result", "minutes"):
            if k in value:
                return text_of(value[k]) if not isinstance(value[k], str) else value[k]
        return " ".join(x for x in map(text_of, (v for k, v in value.items() if k not in ("base_model", "edits", "overlap"))) if x)
    if isinstance(value, list):
        return " ".join(x for x in map(text_of, value) if x)
    return value if isinstance(value, str) else ""


def parse_reply(reply: str) -> Parsed:
    """Read a reply in one scan; linear in its length but for the JSON value, which is read once more by the JSON reader."""
    stack: list[tuple[str, str]] = []  # (kind, what closes it)
    parts: list[str] = []  # the body, without think blocks and fence lines
    taken = pos = 0
    last_listed = -1
    shut_tags = {m.group(1).lower() for m in re.finditer(r"</([A-Za-z][A-Za-z0-9]*)", reply)}
    crossed: list[str] = []

    def body() -> str:
        return "".join([*parts, reply[taken:]]).strip()

    while True:
        m = _LEX.search(reply, pos)
        if m is None:
            break
        pos, kind = m.end(), m.lastgroup
        top = stack[-1][0] if stack else ""
        if m.group("think"):
            if m.group("endthink"):
                if top == "think":
                    stack.pop()
                    taken = pos if not any(k == "think" for k, _ in stack) else taken
                continue
            if top != "fence":
                if top != "think":
                    parts.append(reply[taken : m.start()])
                stack.append(("think", ""))
            continue
        if top == "think":
            nxt = _THINK.search(reply, m.start())
            pos = nxt.start() if nxt else len(reply)
            continue
        if m.group("fence"):
            mark = m.group("fence")
            if top == "fence":
                if mark[0] == stack[-1][1][0] and len(mark) >= len(stack[-1][1]) and not m.group("info").strip():
                    stack.pop()
                    parts.append(reply[taken : m.start()])
                    taken = pos
            else:
                parts.append(reply[taken : m.start()])
                taken = pos
                stack.append(("fence", mark))
            continue
        opened = m.group("open")
        if opened in ("{", "[") and _JSON_HEAD.match(reply, m.start()):
            lead = "".join([*parts, reply[taken : m.start()]])
            if not lead.strip() or re.search(r"[:：.。!！]\s*\Z|\n[ \t]*\Z", lead):
                end = json_end(reply, m.start())
                if end is None:
                    return Parsed(True, body(), None, True)
                after = reply[end:].strip()
                if not re.match(r"[\w，,]", after) or "\n" in reply[end:][: len(reply[end:]) - len(reply[end:].lstrip())]:
                    try:
                        value = json.loads(reply[m.start() : end], strict=False)
                    except ValueError:
                        return Parsed(True, body(), None, True)
                    open_fence = top == "fence" and not re.search(rf"^[ \t]*{re.escape(stack[-1][1][0])}{{{len(stack[-1][1])},}}[ \t]*$", reply[end:], re.M)
                    return Parsed(open_fence, body(), text_of(value), True)
        if top == "fence":
            continue
        if top == "code" and not m.group("code"):
            continue
        if m.group("interval"):
            continue
        if m.group("item") is not None:
            last_listed = pos
            if not reply[pos:].strip():
                stack.append(("item", ""))
        elif m.group("listed") is not None:
            last_listed = pos
        elif m.group("tag"):
            name = m.group("tag").lower()
            if m.group("selfend") or not (name in ELEMENTS or name in shut_tags):
                continue
            if not m.group("endtag"):
                stack.append(("tag", name))
            elif any(k == "tag" and n == name for k, n in stack):
                while stack and stack[-1] != ("tag", name):
                    k, n = stack.pop()
                    if not (k == "tag" and n in OPTIONAL_END):
                        crossed.append(n or k)
                stack.pop()
        elif m.group("code"):
            if top == "code":
                if stack[-1][1] == m.group("code"):
                    stack.pop()
            else:
                stack.append(("code", m.group("code")))
        elif m.group("bold"):
            if any(k == "bold" and n == m.group("bold")[:2] for k, n in stack):
                while stack.pop() != ("bold", m.group("bold")[:2]):
                    pass
            elif not (reply[m.start() - 1 : m.start()].isalnum() and reply[pos : pos + 1].isalnum()) and pos < len(reply) and not reply[pos].isspace():
                stack.append(("bold", m.group("bold")[:2]))
        elif m.group("quote"):
            if any(k == "quote" for k, _ in stack):
                while stack[-1][0] != "quote":
                    crossed.append(stack.pop()[1])
                stack.pop()
            elif not reply[m.start() - 1 : m.start()].isdigit():
                stack.append(("quote", '"'))
        elif opened:
            stack.append(("bracket", PAIRS[opened]))
        elif kind == "shut":
            mark = m.group("shut")
            if any(k == "bracket" and n == mark for k, n in stack):
                while stack[-1] != ("bracket", mark):
                    crossed.append(stack.pop()[1])
                stack.pop()
    blocks = [k for k, _ in stack if k in ("think", "fence")]
    if "think" in blocks:
        return Parsed(True, "".join(parts).strip(), None, False)
    left = [n or k for k, n in stack if k != "fence" and not (k == "tag" and n in OPTIONAL_END)] + crossed
    whole = body()
    return Parsed(bool(blocks), whole, whole, False, left, last_listed >= 0 and "\n" not in reply[last_listed:].strip() and bool(reply[last_listed:].strip()))


_ITEM = re.compile(r"^[ \t]*(?:[-*•+]|\d{1,3}[.)、．])[ \t]+(.*\S)[ \t]*$", re.M)


def breaks_off(p: Parsed, closing: str) -> bool:
    """Whether a plain reply broke off: a mark stays open, or it ends without closing punctuation, a link or a list item."""
    if p.left_open:
        return True
    tail = re.sub(r"[\s\u200b-\u200f\ufeff]+$", "", p.body)
    if not tail or tail[-1] in closing or _WHOLE_END.search(tail):
        return False
    earlier = _ITEM.findall(p.body)[:-1] if p.list_end else []
    return not earlier or any(x[-1] in closing for x in earlier)  # a list of items without full stops may end in one
