"""Secrets in texts: keyword prefilter, anchored patterns near hits, embedded checksums.

One pass of an Aho-Corasick automaton over a text finds the keywords of all kinds. Only
where a keyword begins is the kind's pattern tried, anchored there. Runs of hexadecimal
digits have no keyword; a pattern of single-character runs finds them. Kinds with a
checksum in the secret itself are then held against it. A private key reaches from its first
line to its last; without a last line, over the run of its base64.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from veilspark.llm.common import in_chunks

_UPPER = {c: c + 32 for c in range(65, 91)}
#: Fixed value: the digits of base 62.
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_at_end(value: str) -> bool:
    """The last six characters are the CRC-32 of the thirty before, in base 62."""
    body, number = value[-36:-6], 0
    for character in value[-6:]:
        number = number * 62 + _BASE62.index(character)
    return number == zlib.crc32(body.encode())


_TOKEN = re.compile(r"[A-Za-z0-9_-]*+")
_JSON_MARK = re.compile(r'"(?:[^"\\]|\\.)*+"|[{}\[\]"\\]', re.S)


def _objects(plain: str, at: int, seen: set[int], whole: set[int]) -> None:
    """Adds to `seen` where objects begin in `plain` from `at` on, outside strings, and to `whole` which end where it ends."""
    last, open_ = len(plain.rstrip("\x20\t\r\n")) - 1, []
    for match in _JSON_MARK.finditer(plain, at):
        mark, place = match[0], match.start()
        if mark in ("{", "["):
            open_.append(place)
            if mark == "{":
                seen.add(place)
        elif mark in ("}", "]"):
            if open_:
                begun = open_.pop()
                if place == last:
                    whole.add(begun)
        elif mark in ('"', "\\"):  # no JSON from here on
            return




class Tokens:
    """Signed web tokens of a text: three runs of token characters, the first a JSON object that names an algorithm.

    A run is measured and decoded once, however many keywords begin in it.
    """

    def __init__(self, text: str):
        self.text = text
        self.first = self.end = 0  # ends of the run in hand, and of the token that it begins
        self.decoded: dict[int, str | None] = {}
        self.objects: dict[int, tuple[set[int], set[int]]] = {}

    def __call__(self, start: int) -> int:
        """The end of the token that begins at `start`, 0 if none does."""
        if start >= self.first:
            ends = [_TOKEN.match(self.text, start).end()]
            while len(ends) < 3 and self.text.startswith(".", ends[-1]):
                ends.append(_TOKEN.match(self.text, ends[-1] + 1).end())
                if ends[-1] == ends[-2] + 1:
                    break
            whole = len(ends) == 3 and ends[2] > ends[1] + 1
            self.first, self.end, self.decoded = ends[0], ends[2] if whole else 0, {}
        return self.end if self.end and self._names_algorithm(start) else 0

    def _names_algorithm(self, start: int) -> bool:
        # Starts that are whole groups of four characters apart share their bytes, read as one character each.
        size, phase = self.first - start, start % 4
        if phase not in self.decoded:
            padded = self.text[start : self.first] + "=" * (-size % 4)
            plain = None if size % 4 == 1 else base64.urlsafe_b64decode(padded).decode("latin-1")
            self.objects[phase] = set(), set()
            self.decoded[phase] = plain if plain and plain.rstrip("\x20\t\r\n").endswith("}") else None
        plain = self.decoded[phase]
        if plain is None:
            return False
        at = len(plain) - size * 3 // 4
        seen, whole = self.objects[phase]
        if at not in seen:
            _objects(plain, at, seen, whole)
        if at not in whole:
            return False
        try:
            header = json.loads(plain[at:])
        except (ValueError, RecursionError):
            return False
        if not isinstance(header, dict) or "alg" not in header:
            return False
        try:
            plain[at:].encode("latin-1").decode("utf-8", "surrogatepass")
        except ValueError:
            return False
        return True


#: What ends the search for a key's last line: that line, or the first line of anything else.
_MARK = re.compile(r"-----(?:BEGIN |END (?P<label>(?:[A-Z0-9]{1,20} ){0,4})PRIVATE KEY-----)")
#: Between the parts of a key's text: white space, written out or not, and what quotes or joins lines.
_GAP = r"(?:[\s\"'`,;>#|*]|\\+[nrt]?|\+(?=[\s\"']))"
_ENDED = r"(?=[\s\"'`,;\\<]|-----|\Z)"
#: The end of a line, written out or not, and what may stand around it. No empty line.
_NEXT_LINE = r"(?:[\x20\t\"',;+]|\\+r)*+(?:\\+n(?:[\x20\t\"',+]*+[\r\n]++)?|\r?\n|\r)[\x20\t\"'>#|*]*+"
#: Headers, runs of 16 base64 characters and more, and last a shorter one: a whole line, padded, or the end of the text.
_KEY_BODY = re.compile(
    rf"(?:{_GAP}++[A-Z][A-Za-z0-9]{{0,20}}-[A-Za-z0-9-]{{1,20}}:\x20?[^\s\\\"']++){{0,8}}+"
    rf"(?:{_GAP}++[A-Za-z0-9+/]{{16,}}+=*+{_ENDED})*+"
    rf"(?:{_NEXT_LINE}[A-Za-z0-9+/]++=*+(?=[\"',;\x20\t]*+(?:[\r\n]|\\|-----|\Z))"
    rf"|{_GAP}++[A-Za-z0-9+/]++(?:={{1,2}}{_ENDED}|(?=\s*+\Z)))?+"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/]{16,}+=*+")
_LEFT = re.compile(rf"{_GAP}*+")


def _key_end(match: re.Match) -> int:
    """Where the private key ends whose first line matched.

    What stands before its last line is the key if most of it is base64, however the lines are
    quoted. Else, or without a last line, the key is the base64 that follows. No text is looked
    at twice, as nothing is searched beyond the next first line.
    """
    text, start = match.string, match.end()
    mark = _MARK.search(text, start)
    closed = mark is not None and mark["label"] is not None
    if closed:
        between = text[start : mark.start()]
        if 2 * sum(map(len, _BASE64.findall(between))) >= sum(map(len, between.split())):
            return mark.end()
    stop = _KEY_BODY.match(text, start).end()
    return mark.end() if closed and _LEFT.match(text, stop).end() == mark.start() else stop


@dataclass(frozen=True)
class Kind:
    """`pattern` is tried where one of `words` begins; `holds` sees the match, and `end` says where it ends.

    Matches of one kind don't overlap, the leftmost first, also those that don't hold.
    `any_case`: the words are letters of either case. `finder`, made for a text, takes the place
    of `pattern`: it gives the end of the secret at a start, or 0, and only secrets don't overlap.
    """

    name: str
    words: tuple[str, ...]
    pattern: re.Pattern | None = None
    holds: Callable[[re.Match], bool] = bool
    any_case: bool = False
    end: Callable[[re.Match], int] = re.Match.end
    finder: Callable[[str], Callable[[int], int]] | None = None


#: The kinds, in the order in which spans of one start are listed. The first two
#: and HEX are the base, the others add spans.
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I),
        lambda match: len(match[2]) >= 8,
        any_case=True,
    ),
    Kind("access", ("AKIA",), re.compile(r"AKIA[A-Z0-9]+"), lambda match: len(match[0]) >= 16),
    Kind(
        "github",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
        lambda match: _crc_at_end(match[0]),
    ),
    Kind("npm", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda match: _crc_at_end(match[0])),
    Kind("jwt", ("eyJ",), finder=Tokens),
    Kind(
        "private_key",
        ("-----BEGIN ",),
        re.compile(r"-----BEGIN ([A-Z0-9]{1,20} ){0,4}PRIVATE KEY-----"),
        lambda match: True,
        end=_key_end,
    ),
)
ORDER = {name: place for place, name in enumerate(("assign", "access", "hex", *(kind.name for kind in KINDS[2:])))}
BASE = ("assign", "access", "hex")


@lru_cache(maxsize=1)
def automaton():
    """Keywords of all kinds in lower case, each with the kinds and spellings it may begin."""
    import ahocorasick

    found: dict[str, list[tuple[int, str | None]]] = {}
    for number, kind in enumerate(KINDS):
        for word in kind.words:
            found.setdefault(word.lower(), []).append((number, None if kind.any_case else word))
    machine = ahocorasick.Automaton()
    for word, uses in found.items():
        machine.add_word(word, (len(word), uses))
    machine.make_automaton()
    return machine


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets of a text by start, then kind; code points, end exclusive."""
    spans = [("hex", match.start(), match.end()) for match in HEX.finditer(text)]
    hits = []
    low = text.lower()  # of more characters than `text` only if a dotted capital I is there
    for last, (length, uses) in automaton().iter(low if len(low) == len(text) else text.translate(_UPPER)):
        hits += [(last - length + 1, number) for number, word in uses if word is None or text.startswith(word, last - length + 1)]
    ends = [0] * len(KINDS)
    finders = {number: kind.finder(text) for number, kind in enumerate(KINDS) if kind.finder}
    for start, number in sorted(hits):
        kind = KINDS[number]
        if start < ends[number]:
            continue
        if number in finders:
            if stop := finders[number](start):
                ends[number] = stop
                spans.append((kind.name, start, stop))
        elif match := kind.pattern.match(text, start):
            ends[number] = kind.end(match)
            if kind.holds(match):
                spans.append((kind.name, start, ends[number]))
    return sorted(spans, key=lambda span: (span[1], ORDER[span[0]], span[2]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """`text` with each run of overlapping spans replaced by the kind of its first, in brackets."""
    out, at, end = [], 0, -1
    for kind, start, stop in spans:
        if start >= end:
            out += [text[at:start] if at <= start else "", f"[{kind}]"]
        end = max(end, stop)
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """`doc_id` and `spans` (array of kind, begin, stop) of each row of `docs` (doc_id, text).

    Null and empty texts have no spans. Repeated rows give repeated results; a null doc_id
    stays null. Other columns are ignored. Texts are scanned whole, in time that grows with them.
    """
    schema = "doc_id long, spans array<struct<kind:string,begin:long,stop:long>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches, "text"):
            found = [find_secrets(text) if text else [] for text in chunk.column("text").to_pylist()]
            spans = pa.array([[{"kind": k, "begin": a, "stop": b} for k, a, b in row] for row in found], kind)
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), spans], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def redact_documents(docs: DataFrame) -> DataFrame:
    """`docs` with the secrets in `text` replaced by their kind in brackets, and n_chars set anew.

    All rows and columns stay; a null text stays null, and so does its n_chars. Texts without
    secrets stay as they are.
    """
    names, place = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches, "text"):
            texts = chunk.column("text").to_pylist()
            cleaned = [redact(text, find_secrets(text)) if text else text for text in texts]
            columns = list(chunk.columns)
            columns[place] = pa.array(cleaned, pa.string())
            if "n_chars" in names:
                old = chunk.column("n_chars")
                counts = [n if a == b else len(b) for n, a, b in zip(old.to_pylist(), texts, cleaned)]
                columns[names.index("n_chars")] = pa.array(counts, old.type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
