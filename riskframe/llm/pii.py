"""Personal data: fixed patterns, and a conditional random field over word shapes.

The base spans come from four patterns with checks (email, ip, card, phone), each
kind leftmost and non-overlapping; a match that fails its check is dropped. They
always stay. A linear-chain field then labels the words of the text; its features
are the shapes of a word and of its neighbours, it is trained from the small
labelled table ``LABELLED`` below, and it is decoded by Viterbi in numpy batches.
A span that it finds is added if it overlaps no base span and passes the check of
its kind: so written-out forms that the patterns miss are found too (a phone
number without a plus sign, an address with ``(at)``).

Offsets count code points, ends are exclusive. Null and empty texts have no span.
The field reads a line as runs of ``RUN`` words, so a very long line costs no more
per word. Rows are kept as they are, repeated ones and null keys included; other
columns take no part in ``find`` and are kept by ``mask``.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import WordCache, bounded_batches, texts_of
from riskframe.llm.crf import Crf, viterbi

KINDS = ("email", "ip", "card", "phone")
RUN = 128
#: Words of a batch that are decoded together.
DECODE_WORDS = 400_000

# ---- base patterns ------------------------------------------------------------

# Possessive runs and the look-behind leave the matches as they are and keep the
# time linear: a run of digits can match from its start or not at all.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
Span = tuple[int, int, int]  # start, number of the kind, end


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 14 <= len(digits) <= 19 and _luhn(digits)


def is_phone(text: str) -> bool:
    return 10 <= len(_digits(text)) <= 15


def base_spans(text: str) -> list[Span]:
    """By start, then kind."""
    found: list[Span] = []
    if "@" in text:
        free = 0
        at = text.find("@")
        while at >= 0:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            m = _DOMAIN.match(text, at) if start < at else None
            if m:
                found.append((start, 0, m.end()))
                free = m.end()
            else:
                free = at + 1
            at = text.find("@", free)
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if is_ip(m[0])]
    found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if m.end() - m.start() > 13 and is_card(m[0])]
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if is_phone(m[0])]
    return sorted(found)


# ---- the labelled table -------------------------------------------------------

# The labelled table. Words of one span stand between [ and its
# kind; # is any digit, @w any word. Lines without a span teach what is none.
LABELLED = """
call [ (###) ###-#### phone] today
tel. [ ###-###-#### phone] , ask for @w
phone: [ ### ### #### phone]
fax [ ###.###.#### phone] or write
mobile [ 0## ######## phone] please
dial [ 00## ### ####### phone] now
reach me on [ +# (###) ###-#### phone] , thanks
number [ +## ### ### #### phone]
@w @w [ +# (###) ###-#### phone] @w @w
mail [ @w.##@@w#.example.com email] soon
write to [ @w@@w.org email]
contact [ @w (at) @w.com email] or
e-mail [ @w [at] @w.org email] today
send it to [ @w at @w dot com email] please
@w [ @w_##@@w.net email] @w
server [ ##.###.#.## ip] is down
address [ ###.##.##.### ip] port ####
@w @w [ ##.###.##.## ip] @w
card [ #### #### #### #### card] expires ##/##
pay with [ ####-####-####-#### card]
@w [ ################ card] @w @w
account [ ###### ########## card]
order ######## was sent
the year #### and page ###
version #.#.# of @w
room ### @w @w
price #.## or ##,###
on ##/##/#### at ##:##
token = "##w##w##"
id ########## @w
isbn ###-#-##-######-#
part no. ##-####-##
section #.#.#.#.# @w
the sum of ### ### is ####
@w at @w dot @w @w
we met at @w and left
@w (at) @w
@w @w @w @w @w @w
@w, @w @w. @w @w
@w### @w$$$ @w&&& @w***
@w | @w | @w | #### | ##
ratio ###:### in ####-####
code ### ### ### ###
table ### ### #### rows
timestamp ########## ms
tel @w fax @w
"""

LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]


def labelled_rows(copies: int = 20, seed: int = 5) -> list[tuple[list[str], list[int]]]:
    """The table's lines as words with labels, each filled in ``copies`` ways."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 10)))
    out = []
    for line in LABELLED.strip().splitlines():
        for _ in range(copies):
            words, labels, kind, first = [], [], None, False
            parts = line.split(" ")
            for n, p in enumerate(parts):
                if p == "[":
                    end = next(x for x in parts[n:] if x.endswith("]") and x[:-1] in KINDS)
                    kind, first = KINDS.index(end[:-1]), True
                elif kind is not None and p.endswith("]") and p[:-1] in KINDS:
                    kind = None
                else:
                    p = re.sub("@w", lambda _: word(), re.sub("#", lambda _: str(rng.randint(0, 9)), p))
                    p = p.capitalize() if rng.random() < 0.2 else p
                    if kind is not None and labels and words and rng.random() < 0.05:
                        p += rng.choice(".,")
                    words.append(p)
                    labels.append(0 if kind is None else 1 + 2 * kind + (not first))
                    first = False
            out.append((words, labels))
    return out


# ---- features -----------------------------------------------------------------

_SHAPE = str.maketrans({**{c: "d" for c in "0123456789"},
                        **{c: "x" for c in "abcdefghijklmnopqrstuvwxyz"},
                        **{c: "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}})
_CUES = frozenset("at dot (at) [at] (dot) call dial tel tel. phone fax mobile number mail e-mail contact write "
                  "server address card account pay isbn order id token version".split())


def shape(word: str) -> str:
    """Digits as d, letters as x and X, other signs as they are; runs of letters
    count as one, runs of digits up to six, long words by both ends."""
    low = word.strip(".,;:!?").lower()
    if low in _CUES:
        return "=" + low
    s = word if len(word) <= 40 else word[:20] + word[-20:]
    s = "".join(c if c < "\x80" else ("x" if c.isalpha() else "?") for c in s) if not s.isascii() else s
    s = re.sub(r"[xX]+", "x", s.translate(_SHAPE))
    return re.sub(r"d{7,}", lambda m: "d" * 7 if len(m[0]) < 14 else "d" * 8, s)


def shape_names(s: str) -> list[str]:
    """What a shape says, for a field's weights."""
    core = s.strip(".,;:!?")
    n = s.count("d")
    names = [f"s{s}", f"c{core}", f"n{min(n, 20)}", f"r{re.sub('d+', 'd', core)}"]
    names += [f"h{c}" for c in "@+()-.:/=\"_,#" if c in core]
    if not n and "@" not in core and not s.startswith("="):
        names.append("plain")
    return names


class PiiModel:
    def __init__(self):
        rows = labelled_rows()
        self.numbers: dict[str, int] = {}
        shapes: dict[str, int] = {}
        tokens, labels, lengths = [], [], []
        for words, gold in rows:
            tokens += [shapes.setdefault(shape(w), len(shapes)) for w in words]
            labels += gold
            lengths.append(len(words))
        names = [shape_names(s) for s in shapes]
        # a token's features: its shape's, and its neighbours' marked as such
        per = [[self.numbers.setdefault(f"{side}{x}", len(self.numbers) + 1) for side in "0-+" for x in found]
               for found in names]
        split = [len(found) for found in names]
        edge = {side: self.numbers.setdefault(f"{side}end", len(self.numbers) + 1) for side in "-+"}
        types: dict[tuple, int] = {}
        seq, at = [], 0
        for n in lengths:
            for i in range(n):
                t = tokens[at + i]
                left = per[tokens[at + i - 1]][split[tokens[at + i - 1]]:2 * split[tokens[at + i - 1]]] if i else [edge["-"]]
                right = per[tokens[at + i + 1]][2 * split[tokens[at + i + 1]]:] if i + 1 < n else [edge["+"]]
                seq.append(types.setdefault((*per[t][:split[t]], *left, *right), len(types)))
            at += n
        begins = np.cumsum([0, *map(len, types)])[:-1]
        self.crf = Crf(len(self.numbers) + 1, len(LABELS)).fit(
            np.array([n for x in types for n in x]), begins, np.array(seq), np.array(lengths),
            np.array(labels), rounds=120, rate=0.1, ridge=0.02)
        self.edges = [self.crf.weights[edge[s]] for s in "-+"]
        self.known: dict[str, int] = {}
        self.tables = np.zeros((3, 0, len(LABELS)), np.float32)
        self.cache: WordCache | None = None

    def __getstate__(self):
        return {**self.__dict__, "cache": None, "known": {}, "tables": self.tables[:, :0]}

    def _number(self, words: list[str]) -> list[bytes]:
        fresh, found = [], []
        for w in words:
            s = shape(w)
            if s not in self.known:
                self.known[s] = len(self.known)
                fresh.append(s)
            found.append(self.known[s].to_bytes(4, "little"))
        if fresh:
            rows = np.array([[self.crf.weights[[self.numbers.get(side + x, 0) for x in shape_names(s)]].sum(axis=0)
                              for s in fresh] for side in "0-+"], np.float32)
            self.tables = np.concatenate((self.tables, rows), axis=1)
        return found

    def labels(self, words: list[str], lengths: list[int]) -> np.ndarray:
        """Viterbi labels of words that form runs of these lengths."""
        if not words:
            return np.empty(0, np.int8)
        if self.cache is None or len(self.known) > 200_000:
            self.known, self.tables = {}, self.tables[:, :0]
            self.cache = WordCache(self._number)
        ids = np.frombuffer(b"".join(self.cache.values(words)), "<u4").astype(np.int64)
        own, left, right = self.tables
        scores = own[ids].astype(np.float64)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        before, after = left[ids], right[ids]
        scores[1:] += before[:-1]
        scores[:-1] += after[1:]
        # across the border of two runs there is no neighbour
        inner = starts[1:]
        scores[inner] -= before[inner - 1]
        scores[inner - 1] -= after[inner]
        scores[starts] += self.edges[0]
        scores[ends - 1] += self.edges[1]
        return viterbi(scores, np.asarray(lengths), self.crf.begin, self.crf.move)


# ---- spans --------------------------------------------------------------------

_WORD = re.compile(r"\S+")
_OPEN, _CLOSE = "\"'<[{,;:!?", "\"'>]},;:!?."


def _passes(kind: int, text: str) -> bool:
    if kind == 0:
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+(?:@|\s?[(\[]at[)\]]\s?|\sat\s)[A-Za-z0-9-]+"
                                 r"(?:(?:\.|\s?[(\[]dot[)\]]\s?|\sdot\s)[A-Za-z0-9-]+)+", text))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9.]+", text)) and is_ip(text)
    if kind == 2:
        return bool(re.fullmatch(r"[0-9 -]+", text)) and is_card(text)
    return bool(re.fullmatch(r"\+?[0-9(][0-9().\s-]*[0-9]", text)) and is_phone(text)


def added_spans(texts: list[str], model: PiiModel, base: list[list[Span]]) -> list[list[Span]]:
    """The field's spans of every text that overlap no base span."""
    out: list[list[Span]] = [[] for _ in texts]
    todo: list[tuple[int, list[str], list[int]]] = []
    held = 0

    def flush():
        nonlocal held
        words = [w for _, ws, _ in todo for w in ws]
        lengths = [n for _, _, ns in todo for n in ns]
        labels = model.labels(words, lengths)
        at = 0
        for i, ws, ns in todo:
            own = labels[at:at + len(ws)]
            at += len(ws)
            if own.any():
                out[i] += _cut(texts[i], own, np.concatenate(([0], np.cumsum(ns)[:-1])), base[i])
        todo.clear()
        held = 0

    for i, text in enumerate(texts):
        words: list[str] = []
        lengths: list[int] = []
        for line in text.split("\n"):
            ws = line.split()
            words += ws
            lengths += [min(RUN, len(ws) - a) for a in range(0, len(ws), RUN)]
        if words:
            todo.append((i, words, lengths))
            held += len(words)
            if held >= DECODE_WORDS:
                flush()
    if todo:
        flush()
    return out


def _cut(text: str, labels: np.ndarray, starts: np.ndarray, base: list[Span]) -> list[Span]:
    """Labels of the text's words as checked spans of characters."""
    begins = set(starts.tolist())
    found, runs = [], []
    for w in np.flatnonzero(labels).tolist():
        kind, inner = (labels[w] - 1) // 2, (labels[w] - 1) % 2
        if runs and inner and runs[-1][1] == w and runs[-1][2] == kind and w not in begins:
            runs[-1][1] = w + 1
        else:
            runs.append([w, w + 1, int(kind)])
    if not runs:
        return found
    at = [m.span() for m in _WORD.finditer(text)]
    for a, b, kind in runs:
        start, end = at[a][0], at[b - 1][1]
        while start < end and text[start] in _OPEN:
            start += 1
        while end > start and text[end - 1] in _CLOSE:
            end -= 1
        if _passes(kind, text[start:end]) and not any(s < end and start < e for s, _, e in base):
            found.append((start, kind, end))
    return found


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of every
    row; the counts and the digest are of the base spans, ``spans`` lists all."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(PiiModel())
    bounded_batches(spark)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = f["text"].tolist()
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, shared.value, base)
            rows = {"doc_id": f["doc_id"].astype("Int64")}
            for k, name in enumerate(KINDS):
                rows[f"n_{name}"] = [sum(s[1] == k for s in b) for b in base]
            rows["base_sha256"] = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            rows["spans"] = [_joined(sorted(b + m)) for b, m in zip(base, more)]
            yield pd.DataFrame(rows)

    return texts_of(docs, key, text).mapInPandas(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns, with every span of ``text`` replaced by its
    kind in angle brackets (of overlapping spans, by the first). Null stays null."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(PiiModel())
    bounded_batches(spark)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        whole = [t or "" for t in texts]
        base = [base_spans(t) for t in whole]
        more = added_spans(whole, shared.value, base)
        out = []
        for t, original, b, m in zip(whole, texts, base, more):
            done, parts = 0, []
            for start, kind, end in sorted(b + m):
                if start >= done:
                    parts += [t[done:start], f"<{KINDS[kind].upper()}>"]
                done = max(done, end)
            out.append("".join(parts) + t[done:] if parts else original)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, masked(F.col(text)))
