"""Secrets in texts: fixed patterns, and literals assigned to sensitive names.

The method reads source and configuration syntax as pairs of a name and a value (``name = value``, ``name: value``, ``"name": "value"``,
``name := value``, ``name => value``), where the name may be a subscript (``config["name"] = value``), an array (``name[] = value``) or
typed (``name: type = value``, ``var name type = value``). A value may begin on the next line, in a bracket, or be a list in one. Elements
(``<name>value</name>``) and calls that begin with a name in quotes (``get("name", "value")``) are pairs too. A value in quotes,
escapes and blocks of three quotes included, or a bare one with a digit, is a literal; literals joined by ``+``, ``.`` or ``&`` are one. A value that is a name defined
before it in the text stands for that name's literal (constants are propagated, through any number of names, until the name gets another value). A literal is
reported when the score of the target name and of the literal together reach the threshold: words such as
``password`` or ``credential`` in the name; length, mixture of character kinds and entropy of the literal. Literals of one
character kind count by length and entropy alone. Placeholders and literals with blanks score nothing.

Left out: arguments of calls without a name in quotes before them, literals joined without a sign, chained assignments but for the last name.

All work is inside one row, so there is no shuffle. Texts without an assignment sign skip the lexer, as they have no pair.

Defined results: null text is empty. Every row gives one row, with null and repeated ids too. An empty table gives
an empty result; other columns are not read. Spans count code points, the end is exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import prepare, sha256

#: The base patterns, and the order of the kinds. Runs are maximal, so a least length can stand in the pattern.
KINDS = ("assign", "access", "hex", "literal", "propagated")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
_KEYWORDS = ("passw", "secret", "token", "key")

#: Words of names, and what they add to the score.
SENSITIVE = {
    "password": 2.0, "passwd": 2.0, "pwd": 2.0, "passphrase": 2.0, "secret": 2.0, "token": 2.0, "credential": 2.0,
    "credentials": 2.0, "apikey": 2.0, "privatekey": 2.0, "accesskey": 2.0, "secretkey": 2.0, "authtoken": 2.0,
    "auth": 1.0, "bearer": 1.0, "private": 1.0, "api": 1.0, "access": 1.0, "key": 1.0, "signing": 1.0,
}
_ENDS = [word for word, adds in SENSITIVE.items() if adds == 2.0]
THRESHOLD = 4.0
SHORTEST = 8
_FILLER = re.compile(r"(?i)change|example|sample|placeholder|your|dummy|redact|secret|password")
_PLACEHOLDER = re.compile(r"(?i)none\Z|null\Z|true\Z|false\Z|(.)\1*\Z")
_LEFT = 6  # letters and digits that must be left of a literal without its filler words
_TYPE = (
    r"""[&*]{0,2}(?:'\w+[ \t]+)?(?:(?:mut|dyn|const|unsigned)[ \t]+)?[A-Za-z_][\w.]*(?:::[A-Za-z_]\w*)*"""
    r"""(?:\[[^\n=\[\]]{0,80}(?:\[[^\n=\[\]]{0,80}\][^\n=\[\]]{0,80})?\]|<[^\n=]{0,80}>|\(\d*\))?(?:\[\])*[?!*&]?"""
)
_ASSIGNED = r"""(?=[ \t]+=(?![=>])|=[ \t]*["'])"""  # else a sign inside a bare value, as in base64
_QUOTED = (
    r"""(?:\"\"\"(?P<block>(?:[^"\\]|\\[\s\S]|"(?!""))*+)\"\"\"|'''(?P<long>(?:[^'\\]|\\[\s\S]|'(?!''))*+)'''"""
    r"""|"(?P<double>(?:[^"\\\n]|\\[\s\S])*+)"|'(?P<single>(?:[^'\\\n]|\\[\s\S])*+)'|`(?P<back>[^`\n]*+)`)"""
)
_PAIR = re.compile(
    r"""(?:(?<![\w.-])(?P<var>[Vv]ar|[Cc]onst|CONST|[Dd]im|[Dd]eclare|DECLARE)[ \t]+@?)?"""
    r"""(?<![\w.-])(?P<quote>["']?)(?P<name>[A-Za-z_][\w.-]*)(?P=quote)(?:[ \t]*\]|[ \t]*\[\d*\])*"""
    rf"""(?:[?!]?[ \t]*:[ \t]*(?P<of>(?P<mark>["']?){_TYPE}(?:[ \t]*\|[ \t]*{_TYPE})*(?P=mark)){_ASSIGNED})?"""
    rf"""(?(var)(?:[ \t]+(?:[Aa][Ss][ \t]+)?(?P<plain>{_TYPE}){_ASSIGNED})?)"""
    r"""[ \t]*(?::=|=>|[:=](?!=))[ \t]*+(?:\\?\n[ \t]*+(?=["'`]))?+(?P<open>[(\[][ \t]*+(?:\n[ \t]*+)?+(?=["'`]))?+(?:[rRbBuUfFL@$]{1,2}(?=["']))?"""
    rf"""(?:{_QUOTED}|(?P<bare>[^\s"'`,;(){{}}\[\]]+))""",
    re.ASCII,
)
_JOINED = re.compile(rf"""[ \t]*+(?:\n[ \t]*+)?+[+.&][ \t]*+(?:\n[ \t]*+)?+{_QUOTED}""", re.ASCII)
_ITEM = re.compile(rf"""\s*+,\s*+{_QUOTED}""", re.ASCII)
_CALL = re.compile(rf"""\([ \t]*+(?P<quote>["'])(?P<name>[A-Za-z_][\w.-]*+)(?P=quote)[ \t]*+,[ \t]*+{_QUOTED}""", re.ASCII)
_ELEMENT = re.compile(r"""<(?P<name>[A-Za-z_][\w.-]*+)>(?P<value>[^<>\s]++)</""", re.ASCII)
#: Words that a declaration has beside the name; no constants.
_TYPE_WORDS = frozenset("str string char bytes byte int integer number any object text varchar nvarchar val let static final".split())
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and not overlapping per kind."""
    spans = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    lower = text.lower()
    if any(word in lower for word in _KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    return spans


def name_score(name: str) -> float:
    """What the words of a name add up to; a word such as ``userpwd`` or ``tokens`` counts as the one it ends with."""
    words = [w.lower() for w in _NAME_WORD.findall(name)]
    found = dict.fromkeys(w if w in SENSITIVE else next((end for end in _ENDS if w.removesuffix("s").endswith(end)), w) for w in words)
    return sum(SENSITIVE.get(w, 0.0) for w in found)


def literal_score(literal: str) -> float:
    """0 for what is no secret; else kinds of characters, entropy and length, at most 4."""
    if len(literal) < SHORTEST or re.search(r"\s", literal) or literal[0] in "$<%{" or _PLACEHOLDER.match(literal) or _FILLER.match(literal):
        return 0.0
    if _FILLER.search(literal) and sum(map(str.isalnum, _FILLER.sub("", literal))) < _LEFT:
        return 0.0
    kinds = sum(any(test(c) for c in literal) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    counts = Counter(literal)
    entropy = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    return float(min(kinds - 1, 2) + (entropy >= 2.5) + (len(literal) >= 12))


def _targets(m: re.Match) -> list[str]:
    """The assigned name; and the word beside it, as ``const string name`` has the type first and ``var name string`` last."""
    beside = _NAME.search(m["of"] or m["plain"] or "")
    names = [m["name"]] if beside is None else [m["name"], beside[0]] if m["plain"] or name_score(beside[0]) >= 2 else [m["name"]]
    return [n for n in names if n.lower() not in _TYPE_WORDS]


def _joined(text: str, m: re.Match) -> tuple[int, int, str, int]:
    """A literal in quotes with those joined to it: start, end, value, and the place behind its last quote."""
    kind = m.lastgroup
    start, end, parts, at = m.start(kind), m.end(kind), [m[kind]], m.end()
    while more := _JOINED.match(text, at):
        kind, at = more.lastgroup, more.end()
        end = more.end(kind)
        parts.append(more[kind])
    return start, end, "".join(parts), at


def _is_secret(names: list[str], value: str) -> bool:
    score = max(map(name_score, names), default=0.0)
    return score >= 2 and (worth := literal_score(value)) > 0 and score + worth >= THRESHOLD


def lexed_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name, directly or through names that stand for them."""
    spans, literals, at = [], {}, 0
    if "=" in text or ":" in text:
        while m := _PAIR.search(text, at):
            kind, at, targets = m.lastgroup, m.end(), _targets(m)
            passed = kind == "bare" and m[kind] in literals
            if passed:
                start, end, value = literals[m[kind]]
            elif kind == "bare" and (_NAME.fullmatch(m[kind]) and not any(c.isdigit() for c in m[kind])):
                at = m.start(kind)  # a call, a name without a known literal, or prose; it may be a target itself
                for name in targets:
                    literals.pop(name, None)
                continue
            elif kind == "bare":
                start, end, value = m.start(kind), m.end(kind), m[kind]
            else:
                start, end, value, at = _joined(text, m)
            literals.update(dict.fromkeys(targets, (start, end, value)))
            if _is_secret(targets, value):
                spans.append((start, 4 if passed else 3, end))
            while m["open"] and (item := _ITEM.match(text, at)):
                start, end, value, at = _joined(text, item)
                if _is_secret(targets, value):
                    spans.append((start, 3, end))
    for m in _CALL.finditer(text) if "(" in text else ():
        start, end, value, _ = _joined(text, m)
        if _is_secret([m["name"]], value):
            spans.append((start, 3, end))
    for m in _ELEMENT.finditer(text) if "</" in text else ():
        if _is_secret([m["name"]], m["value"]):
            spans.append((m.start("value"), 3, m.end("value")))
    return sorted(set(spans))


def secret_spans(text: str) -> list[Span]:
    """All spans of a text by start and kind. A literal inside a base span is not reported again, but through another name it is."""
    base = base_spans(text)
    inside = lambda s: any(b[0] <= s[0] and s[2] <= b[2] for b in base)
    added = {s for s in lexed_spans(text) if s[1] == 4 or not inside(s)}
    return sorted([*base, *added])


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id and ``found``: an array of (kind, start, end)."""
    prepare(docs.sparkSession)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in secret_spans(text or "")]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "found"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {id_type}, found array<struct<kind:string,start:bigint,end:bigint>>")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    base = F.filter("found", lambda s: s["kind"].isin(*KINDS[:3]))
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    counted = [of(kind) for kind in KINDS[:3]]
    return find_secrets(docs).select("doc_id", *counted, sha256(_listed(base)).alias("base_sha256"), _listed(F.col("found")).alias("spans"))
