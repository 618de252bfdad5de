"""Template residue and error-page text (problem 9).

A multi-pattern automaton runs once over the lower-cased text cells of a document and finds the
telling phrases of error pages, script notices and filler, in some 25 languages, and the openers
of template fields.  What it finds counts by coverage, sentence by sentence:

* a *field* counts wherever it stands, its least coverage being nothing;
* a sentence with a telling phrase counts when the phrases and the plain words such notices are
  made of cover ``COVERAGE`` of its letters, and the phrases alone ``TELLING`` of them, so that a
  sentence that goes on in words of its own does not;
* a sentence counts as filler when words of the classical filler passage, words that end as Latin
  does, or one word said over and over cover most of it.

Quotations, code in backticks and formulas are left out on both sides.  A document is a case when
any sentence of a text cell counts; its coverage is the share of its text cells' letters in such
sentences, which :func:`marks` gives for stricter choices.  Coverage is asked of sentences first,
since one field or notice within a text cell makes a case.

Code and output cells are not looked at.  Null, empty and blank texts are no cases; a document
without cells is one text cell, less its fenced code; cells whose offsets are null, turned or
beyond the text are cut to the text.  Texts are read whole, in time linear in their length.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import phrases
from strandloom.sources.tables import table

#: Share of a sentence's letters that phrases and plain words, phrases alone, and filler words have to cover.
COVERAGE, TELLING, FILLER = 0.8, 0.15, 0.6

NAME = r"[^\W\d][\w .:-]*+"
#: What a template asks for: a name between delimiters that other texts use too needs one of these words.
NOUNS = (
    "title|subtitle|heading|header|footer|name|fname|lname|surname|firstname|lastname|username|user|author|editor|date|deadline|day|month|year|time|e-?mail|mail|address|street|zip|city|country|state|phone|fax|company|institution|organi[sz]ation"
    "|department|university|institute|school|faculty|client|customer|recipient|sender|student|teacher|instructor|supervisor|course|semester|project|product|subject|topic|url|link|website|domain|version|description|summary|abstract|introduction"
    "|conclusion|figure|image|logo|table|caption|section|paragraph|body|text|content|contact|location|place|venue|event|position|role|job|amount|price|total|number|id|code|license|licence|keywords?|tags?|category|dataset|placeholder|insert|your|replace|todo|tbd"
)
NOUNED = r"(?=[\w .:-]*(?<![^\W_])(?:" + NOUNS + r")(?-i:(?![a-z])))" + NAME
#: A name written as an identifier, in capitals or not: with a dash or underscore, or a capital within.
IDENT = r"(?=[\w-]*(?:\w[_-]\w|(?-i:[a-z][A-Z])))[^\W\d][\w-]*+"
_ASK = "your|insert|enter|add|put|type|choose|select|fill in|describe|write|name of|replace|placeholder|todo|tbd"
#: How each kind of template field opens, and what it has to look like from there on.
FIELDS = {
    "{{": r"\{\{\{?(?:\s*|(?=[^{}\n]*\w)(?:[^{}\n\\]|\}(?!\}))*+)\}\}\}?",
    "${": r"\$\{(?:\{?\s*" + NAME + r"|(?=[^\W\d])[^{}\n$\\]*+|\d+(?=\}(?![^\s$]*\$)))\s*\}?\}",
    "#{": r"#\{(?=[^{}\n]*\w)[^{}\n\\]*+\}",
    "%%": r"%%" + NAME + r"%%",
    "@@": r"@@" + NAME + r"@@",
    "<%": r"<%(?=[^<\n]*\w)(?:[^<%\n]|%(?!>))*+%>",
    "{%": r"\{%(?=[^{\n]*\w)(?:[^{%\n]|%(?!\}))*+%\}",
    "%(": r"%\(" + NAME + r"\)s",
    "*|": r"\*\|" + NAME + r"\|\*",
    "|*": r"\|\*" + NAME + r"\*\|",
    "{#": r"\{#\s*" + NAME + r"\s*#\}",
    "{$": r"\{\$\s*" + NAME + r"\s*\}",
    "[%": r"\[%=?\s*" + NAME + r"\s*%\]",
    "<<": r"<<\s*(?:" + NOUNED + r"|" + IDENT + r"|[^\W\d]\w*+ [\w .:-]*+)\s*>>",
    "«": r"«\s*(?:" + NOUNED + r"|" + IDENT + r")\s*»",
    "[[": r"\[\[\s*(?:" + NOUNED + r"|" + IDENT + r")\s*\]\]",
    "((": r"(?<!\w)\(\(\s*(?:" + NOUNED + r"|" + IDENT + r")\s*\)\)",
    "__": r"(?<!_)_{4,} ?\(" + NAME + r"\)",
    ":tbd}": r":tbd\}",
    ": tbd}": r": tbd\}",
    " goes here]": r" goes here\]",
    " here]": r" here\]",
    '{"error"': r'\{"error":\s*\{?\s*"(?:code|message|status)"',
    **{f"<{w}": rf"<{w}\b[^<>\n]*+>" for w in _ASK.split("|")},
    **{f"[{w}": rf"\[{w}\b[^\[\]\n]*+\](?![(\[:])" for w in _ASK.split("|")},
    **{f"{{{w}": rf"\{{{w}\b[^{{}}\n]*+\}}" for w in _ASK.split("|")},
}
_FIELD = {k: re.compile(v, re.I) for k, v in FIELDS.items()}
_CAPS = r"(?=[A-Z0-9_ -]*(?<![A-Z0-9])(?i:" + NOUNS + r")(?![A-Z0-9]))[A-Z][A-Z0-9_ -]*+"
_CAPITAL = re.compile(r"(?<![\w%\[<$])(?:%" + _CAPS.replace(" -]", "]") + r"%(?![\w%])|\$" + _CAPS.replace(" -]", "]") + r"\$(?!\w)|<" + _CAPS + r">|\[" + _CAPS + r"\](?![(\[:])|\w{1,200}_PLACEHOLDER(?!\w)|PLACEHOLDER_[A-Z_]+)")
#: Endings of Latin, those that its daughters lost, and the short words that stand in any prose of the languages that share them.
_LATIN = re.compile(r"(?:us|um|am|em|im|is|or|at|et|it|ur|nt|ae|que|ere|are|ire|ula|io|tas)$")
_STRONG = re.compile(r"(?:[^lo]us|um|am|em|im|[^e]t|ae|[^e]ur|is)$")
_OWN = re.compile(r"\b(?:the|and|of|is|to|we|are|for|with|that|this|was|were|from|by|on|be|der|die|das|und|ist|nicht|le|la|les|des|une|el|de|los|las|que|en|un|una|por|con|do|da|lo|gli|di|che)\b")
_ASKS = re.compile(r"\b(?:here|insert|describe|add|write|put|enter|type|fill|your|to be|replace|overwrite|summari[sz]e|explain|todo)\b")
_UNIT = re.compile(r"(?<=[.!?。！？])[ \t]+|(?<=[。！？])|[\r\n]+")
_MASH = re.compile(r"(?<![^\W_])(?:[asdfjklqwe]{2,12}[ ]+){7,}")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?(?![^\W_])|[^\W_]+")
_QUOTED = re.compile(r"`[^`\n]*`|\"[^\"\n]*\"|“[^”\n]*”|„[^“”\n]*[“”]|\$[^$\n]*[\\^_=][^$\n]*\$")
#: Whole sentences that tell an author what to put there.
_STUB = re.compile(
    r"\W*+(?:(?:insert|describe|add|write|put|enter|type|place|paste|summari[sz]e|explain|list|state|provide)\b[^.!?]+\bhere\b|[^.!?]+\bgoes here"
    r"|(?<=\()(?:insert|describe|add|write|put|enter|type|fill in|your|to be)\b[^)]+\)|(?:replace|overwrite) (?:this|the)\b[^.!?]*\b(?:text|paragraph|sentence|section|placeholder|instructions?)\b[^.!?]*"
    r"|(?:insert|describe|summari[sz]e|explain|write) (?:the|a|an|your) (?:introduction|summary|abstract|conclusion|results?|dataset|data|methods?|background|caption|title|figure|table|text)(?: here)?"
    r"|todo:? (?:fill in|write|add|describe|complete|insert) (?:this|the|an?|your|some)\b[^.!?]*)\W*",
    re.I,
)
#: Words that stand for text when said over and over.
_SAID_OVER = frozenset("text texto texte testo tekst текст blah bla lorem ipsum foo dummy asdf".split())
_FENCED = re.compile(r"^```.*?^```", re.M | re.S)
_MARKUP = re.compile(r"</?[a-z][^<>\n]*>", re.I)
_TAGS = re.compile(r"<cell kind=\w+[^<>\n]*>|</cell>|^# %% \[markdown\]", re.M)
_PLAIN, _JOINED = phrases.plain()
_JOIN = re.compile("|".join(map(re.escape, _JOINED)))
_LOREM = frozenset(phrases.LOREM.split())
_ALNUM = np.array([chr(c).isalnum() for c in range(0x10000)])


@functools.cache
def automaton() -> ahocorasick.Automaton:
    """All telling phrases, the longer filler words and the openers of fields, each with its kind."""
    a = ahocorasick.Automaton()
    for w in _LOREM:
        if len(w) > 4:
            a.add_word(w, ("filler", len(w)))
    for p in phrases.telling():
        a.add_word(p, ("phrase", len(p)))
    for opener in FIELDS:
        a.add_word(opener, ("field", opener))
    a.make_automaton()
    return a


def _lower(text: str) -> str:
    """Lower case of the same length, with plain apostrophes."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return low.replace("’", "'")


def _units(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    for m in _UNIT.finditer(text):
        if m.start() > at:
            yield at, m.start()
        at = m.end()
    if at < len(text):
        yield at, len(text)


def _whole(low: str, start: int, end: int) -> bool:
    """Whether a find ends and begins with words, in scripts that part words by blanks."""

    def runs(i: int, j: int) -> bool:
        return 0 <= i and j < len(low) and low[i] < "\u0900" and low[j] < "\u0900" and low[i].isalnum() and low[j].isalnum()

    return not runs(start - 1, start) and not runs(end - 1, end)


class _Quotes:
    """Quotations of a cell, found when first asked for."""

    def __init__(self, cell: str):
        self.cell, self.starts, self.ends = cell, None, None

    def hold(self, start: int, end: int) -> bool:
        if self.starts is None:
            spans = [q.span() for q in _QUOTED.finditer(self.cell)]
            self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]
        k = bisect.bisect_left(self.starts, start) - 1
        return k >= 0 and end <= self.ends[k]


def _plain_letters(text: str) -> int:
    """Letters of a stretch in plain words."""
    n = 0
    for m in _WORD.finditer(text):
        w = m[0]
        if w in _PLAIN:
            n += sum(map(str.isalnum, w))
        elif any(map(str.isdigit, w)) and w.isascii():
            n += len(w)  # numbers and the ids of incidents
        elif w > "\u0e00":
            n += sum(len(x[0]) for x in _JOIN.finditer(w))
    return n


def residue_letters(cell: str) -> tuple[int, int]:
    """(letters in sentences that count as residue, all letters) of a text cell."""
    low, quotes = _lower(cell), _Quotes(cell)
    spans, fields = [], set()
    for end, (kind, what) in automaton().iter(low):
        if kind == "field":
            m = _FIELD[what].match(cell, end + 1 - len(what))
            if m and not quotes.hold(m.start(), m.end()):
                fields.add(m.start())
        else:
            start = end + 1 - what
            if _whole(low, start, end + 1) and not quotes.hold(start, end + 1):
                spans.append((start, end + 1, kind))
    for m in _CAPITAL.finditer(cell):
        if f"</{m[0][1:]}" not in cell and not quotes.hold(m.start(), m.end()):
            fields.add(m.start())
    places = np.frombuffer(cell.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.concatenate([[0], np.cumsum(_ALNUM[np.minimum(places, 0xFFFF)])])
    spans.sort()
    opened = sorted(fields)
    hit, k, f = 0, 0, 0
    for a, b in _units(cell):
        first = k
        while k < len(spans) and spans[k][0] < b:
            k += 1
        g = f
        while f < len(opened) and opened[f] < b:
            f += 1
        if f > g or (k > first and _covered(cell, low, letters, spans, first, k, a, b, quotes)) or _filler(low[a:b]):
            hit += int(letters[b] - letters[a])
    if not hit:
        m = _MASH.search(cell)
        hit = len(m[0]) if m else 0
    return hit, int(letters[-1])


def _covered(cell: str, low: str, letters: np.ndarray, spans: list, first: int, last: int, a: int, b: int, quotes: _Quotes) -> bool:
    """Whether the finds ``first`` to ``last`` cover much of the sentence from ``a`` to ``b``."""
    outside = int(letters[b] - letters[a]) - sum(sum(map(str.isalnum, m[0])) for m in _MARKUP.finditer(cell, a, b)) if "<" in cell[a:b] else int(letters[b] - letters[a])
    told = plain = filler = 0
    at, between = a, []
    for start, end, kind in spans[first:last]:
        start, end = max(start, at), min(end, b)
        if start < end:
            between.append(low[at:start])
            n = int(letters[end] - letters[start])
            told += n if kind == "phrase" else 0
            filler += n if kind == "filler" else 0
            at = end
    between.append(low[at:b])
    if filler and filler >= FILLER * outside and sum(w in _LOREM for w in _WORD.findall(low, a, b)) >= 3:
        return True
    if told < TELLING * outside or not told:
        return False
    plain = sum(_plain_letters(_MARKUP.sub(" ", t)) for t in between)
    return told + plain + filler >= COVERAGE * outside


def _filler(unit: str) -> bool:
    """Whether a sentence asks for text, says one word over and over, or reads like Latin by its endings alone."""
    line = unit.strip().lstrip("#*->  ")
    if _ASKS.search(line) and _STUB.fullmatch(line):
        return True
    if len(line) < 3 or not line.isascii() and line[0] != "т":
        return False
    if _OWN.search(line):
        return False
    words = _WORD.findall(line)
    if words and len(set(words)) == 1:
        word, times = words[0], len(words)
        return word in _SAID_OVER and times > (1 if word in ("blah", "bla") else 2) or word in ("tbd", "lorem") or 2 < len(word) <= 20 and word[0] in "xyz" and not word.strip(word[0])
    if len(words) < 7 or len({w for w in words if len(w) > 3 and _STRONG.search(w)}) < 3 or not any(w.endswith(("um", "am", "em", "im", "unt", "ae")) for w in words):
        return False
    return sum(map(len, words)) >= 0.75 * len(line) and sum(len(w) > 3 and _LATIN.search(w) is not None for w in words) >= 0.6 * len(words)


def is_residue(cell: str) -> bool:
    """Whether a text cell holds residue."""
    return residue_letters(cell)[0] > 0


def text_cells(text: str, kinds: list[str] | None, starts: list[int] | None) -> Iterator[str]:
    """The text cells of a document, whole, less the tags between cells; a document without cells is one, less its fenced code."""
    if not starts or not kinds:
        yield _FENCED.sub("", text)
        return
    cuts = [min(max(s or 0, 0), len(text)) for s in starts] + [len(text)]
    for k, (kind, start) in enumerate(zip(kinds, cuts[:-1], strict=False)):
        if kind == "text":
            yield _TAGS.sub("", text[start : max(start, cuts[k + 1])])


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, every = [], []
        for t, kinds, starts in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            cells = [residue_letters(c) for c in text_cells(t, kinds, starts)] if t and not t.isspace() else []
            found.append(sum(h for h, _ in cells))
            every.append(sum(n for _, n in cells))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), pa.array(every, pa.int64()), *batch.columns[4:]], ["doc_id", "n_residue", "n_letters", *batch.schema.names[4:]])


def marks(df: DataFrame, *keep: str) -> DataFrame:
    """(``doc_id``, ``n_residue``, ``n_letters``, ``keep``) for every row of ``df``; repeated rows stay; no shuffle.

    ``n_residue`` counts the letters of the text cells' sentences that are residue, ``n_letters`` all
    of the text cells' letters; both are 0 for null, empty and blank texts.
    """
    kept = "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select("doc_id", "text", "cell_kinds", "cell_starts", *keep).mapInArrow(_mark, f"doc_id long, n_residue long, n_letters long{kept}")


def flagged(df: DataFrame) -> DataFrame:
    """(``doc_id``, ``residue``) for every row of ``df``."""
    return marks(df).select("doc_id", (F.col("n_residue") > 0).alias("residue"))


def found(spark: SparkSession, folder: str) -> DataFrame:
    """p9_found: the documents with residue."""
    return flagged(table(spark, folder, "documents")).where("residue").select("doc_id")


def coverage(spark: SparkSession, folder: str) -> DataFrame:
    """p9_coverage: of every document with residue, the share of its text cells' letters that is residue."""
    m = marks(table(spark, folder, "documents")).where("n_residue > 0")
    return m.select("doc_id", "n_residue", "n_letters", F.coalesce(F.try_divide("n_residue", "n_letters"), F.lit(0.0)).alias("coverage"))


def kept(spark: SparkSession, folder: str) -> DataFrame:
    """p9_kept: the documents left once those with residue are out."""
    return marks(table(spark, folder, "documents"), "source", "n_chars").where("n_residue = 0").select("doc_id", "source", "n_chars")
