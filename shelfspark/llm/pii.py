"""Personal data: pattern spans, and spans of a linear-chain CRF.

Patterns find four base kinds in whole texts. The CRF labels words by the
shapes of themselves and their neighbours; it is trained with exact gradients
(forward-backward) on the small labelled table EXAMPLES. Every word of a text is
labelled, by Viterbi over batches of padded texts; a text of over LONG_TEXT words
is decoded in blocks at once, each from every label that it may begin with, and
the blocks' best paths are then joined, which gives the best path of the whole.
Spans that the CRF finds are added under names of their own (crf_email, crf_phone,
crf_id) if they touch no base span and can be what they are called: an address
spells out its "dot", a phone number has 7 to 15 digits, an identifier 6 to 30.
So texts with neither a digit nor "dot" need no labels. Base spans always stay.

Null texts count as empty. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import Texts, small_batches, without
from shelfspark.llm.words import texts as cut_texts

KINDS = ("email", "ip", "card", "phone", "crf_email", "crf_phone", "crf_id")
#: Viterbi works on so many words at once; longer texts than LONG_TEXT in blocks of BLOCK words.
DECODE_WORDS, LONG_TEXT, BLOCK = 200_000, 4096, 256
#: Distinct words whose scores are kept.
KEPT_WORDS = 100_000

# Patterns of the contract. The local part of an address is looked for to the
# left of its "@"; a run of digits is entered at its start only: a start inside
# it fails wherever the first one does.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        a = at
        while a > done and _LOCAL.match(text, a - 1):
            a -= 1
        m = _DOMAIN.match(text, at) if a < at else None
        if m:
            done = m.end()
            yield a, done
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) by start, then kind."""
    out = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


# --- the labelled table -----------------------------------------------------------------
#: One text per line; {email ...}, {phone ...} and {id ...} mark the spans. Written for this operator.
EXAMPLES = """\
Please write to {email jane.doe at example dot com} before noon.
You can reach me at {email sam (at) mail dot example dot org} any time
contact {email info [at] example [dot] net} for help
mail {email bob_99 at firm dot co} or come by
Her address is {email kim at example dot com} and she lives nearby.
Call me on {phone 555-010-1234} tomorrow.
the office number is {phone (555) 010-4477} or ask the desk
phone {phone 555.010.7788} after six
Tel. {phone 030 1234 5678} in the morning
fax {phone 0301-2345678} only
tel {phone 01 44 55 66 77} pour le bureau
llame al {phone 91 555 01 23} por favor
ring {phone 020 7946 0018} and wait
text {phone 555-019-2020} now
Her social security number is {id 123-45-6789} on file.
SSN {id 987-65-4321} was found
IBAN {id DE89 3704 0044 0532 0130 00} for the rent
pay to {id GB29 NWBK 6016 1331 9268 19} today
passport {id C01X00T47} expires soon
tax id {id 12-3456789} please
Meet me at 5 or at 17:30 in room 12.
In 1999 there were 3 of them and 250 people came.
The price is 19.99 or 1,250 in all, about 30% less.
version 2.0 of the License, see chapter 4.1
on 2024-05-17 at 10:15:30 the run ended
from 12/05/2021 to 13/06/2022 we waited
see page 123 and 124 of volume 7
a 5-day trip of 1200 km with 2 stops
token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" was printed
sha 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08 ok
order 100245 of item 77-A shipped in 3 boxes
look at the map and at the dot on it 3 times
he was at home at 8 and at work at 9
the numbers 1 2 3 4 5 6 and 7 8 9
+ and - are signs, 2 + 2 is 4
v1.2.3-beta build 20240101 on x86_64
4785380592391139$$$ de,&&& 555%%% ra*** 12###
@home and @work are tags with 3 uses
"""
LABELS = ("O", "B-email", "I-email", "B-phone", "I-phone", "B-id", "I-id")
_BEGINS = np.array([x[0] == "B" for x in LABELS])
_WORD = re.compile(r"[^\x20\x09-\x0d]+")
_WHITE = re.compile(r"[\x20\x09-\x0d]+")
_ENDS = ".,;:!?\"'`#*$%&|<>{}"
#: What every span that the CRF adds holds.
_TRIGGER = re.compile(r"\d|dot", re.I)
FEATURES = 1 << 12
_CUES = frozenset("at dot call phone tel tel. fax text ring reach mail write contact ssn iban passport tax id number security "
                  "(at) [at] (dot) [dot] al".split())


def core(word: str) -> tuple[int, int]:
    """Bounds of a word without punctuation at its ends (the word itself if nothing is left)."""
    a, b = 0, len(word)
    while a < b and word[a] in _ENDS:
        a += 1
    while a < b and word[b - 1] in _ENDS:
        b -= 1
    return (a, b) if a < b else (0, len(word))


def shape(word: str) -> list[str]:
    """Features of one word: its shape, its digits, and whether it is a cue."""
    a, b = core(word)
    w = word[a:b]
    s = re.sub(r"[0-9]", "d", re.sub(r"[a-z]", "x", re.sub(r"[A-Z]", "X", w)))
    s = re.sub(r"[^\x00-\x7f]", "x", s)
    short = re.sub(r"(.)\1+", r"\1", s)
    digits = sum(c.isdigit() for c in w)
    return [f"s={s if len(s) <= 12 else short}", f"c={short[:12]}", f"d={min(digits, 12)}", f"n={min(len(w), 15)}",
            f"q={w.lower()}" if w.lower() in _CUES or word.lower() in _CUES else "q", f"a={'@' in w}{'.' in w}{'-' in w}"]


def _feature(name: str) -> int:
    import zlib

    return zlib.crc32(name.encode()) % FEATURES


class Crf:
    """Scores: a weight per (offset, feature) and label, per pair of labels, per first label."""

    OFFSETS = (-2, -1, 0, 1, 2)

    def __init__(self):
        n = len(LABELS)
        self.w = np.zeros((len(self.OFFSETS) * FEATURES, n))
        self.t, self.s = np.zeros((n, n)), np.zeros(n)
        self.ids: dict[str, np.ndarray] = {}
        self.kept: tuple[np.ndarray, np.ndarray] | None = None

    def word_ids(self, word: str) -> np.ndarray:
        ids = self.ids.get(word)
        if ids is None:
            if len(self.ids) > 100_000:
                self.ids.clear()
            ids = self.ids[word] = np.array([_feature(f) for f in shape(word)])
        return ids

    def rows(self, segments: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Weight rows of all words (words, features), and segment lengths. Places beyond a segment have their own row 0."""
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        own = np.stack([self.word_ids(w) for seg in segments for w in seg])
        seg = np.repeat(np.arange(len(segments)), size)
        parts = []
        for k, off in enumerate(self.OFFSETS):
            at = np.arange(len(own)) + off
            ok = (at >= 0) & (at < len(own))
            ok[ok] = seg[at[ok]] == seg[np.flatnonzero(ok)]
            parts.append(np.where(ok[:, None], own[np.where(ok, at, 0)], 0) + k * FEATURES)
        return np.concatenate(parts, 1), size

    def padded(self, segments: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, size = self.rows(segments)
        unary = self.w[rows].sum(1)
        out = np.zeros((len(segments), int(size.max()), len(LABELS)))
        mask = np.arange(out.shape[1]) < size[:, None]
        out[mask] = unary
        return out, mask, rows

    def gradient(self, segments, gold) -> float:
        """One step's gradients of the log-likelihood, left in self.g; returns the likelihood."""
        u, mask, rows = self.padded(segments)
        n, steps, k = u.shape
        lse = lambda x, axis: (m := x.max(axis, keepdims=True), np.log(np.exp(x - m).sum(axis, keepdims=True)) + m)[1].squeeze(axis)
        alpha = np.zeros_like(u)
        alpha[:, 0] = self.s + u[:, 0]
        for t in range(1, steps):
            new = lse(alpha[:, t - 1, :, None] + self.t, 1) + u[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        z = lse(alpha[:, -1], 1)
        beta = np.zeros_like(u)
        g_t, g_s, p = np.zeros_like(self.t), np.zeros_like(self.s), np.zeros_like(u)
        for t in range(steps - 1, -1, -1):
            if t < steps - 1:
                go = mask[:, t + 1, None]
                nxt = u[:, t + 1] + beta[:, t + 1]
                beta[:, t] = np.where(go, lse(self.t + nxt[:, None, :], 2), 0)
                pair = np.exp(alpha[:, t, :, None] + self.t + nxt[:, None, :] - z[:, None, None]) * go[:, :, None]
                g_t -= pair.sum(0)
            p[:, t] = np.exp(alpha[:, t] + beta[:, t] - z[:, None]) * mask[:, t, None]
        g_s -= p[:, 0].sum(0)
        g_w = np.zeros_like(self.w)
        flat_gold = np.concatenate(gold)
        delta = np.eye(k)[flat_gold] - p[mask]
        np.add.at(g_w, rows.reshape(-1), np.repeat(delta, rows.shape[1], axis=0))
        score = 0.0
        for i, g in enumerate(gold):
            g_s[g[0]] += 1
            score += self.s[g[0]] + u[i, np.arange(len(g)), g].sum() + self.t[g[:-1], g[1:]].sum() - z[i]
            np.add.at(g_t, (g[:-1], g[1:]), 1)
        self.g = (g_w, g_t, g_s)
        return score

    def fit(self, segments, gold, steps: int = 120, rate: float = 0.15, ridge: float = 0.02) -> Crf:
        seen = [np.zeros_like(x) for x in (self.w, self.t, self.s)]
        for _ in range(steps):
            self.gradient(segments, gold)
            for x, g, h in zip((self.w, self.t, self.s), self.g, seen):
                g = g - ridge * x
                h += g * g
                x += rate * g / (np.sqrt(h) + 1e-8)
        return self

    def decode(self, segments: list[list[str]]) -> list[np.ndarray]:
        """The best labels of each segment."""
        rows, size = self.rows(segments)
        bounds = np.concatenate([[0], np.cumsum(size)])
        return np.split(self.viterbi(self.w[rows].sum(1), bounds), bounds[1:-1])

    def unary(self, t: Texts) -> np.ndarray:
        """Scores of all words of a slice of texts; those of each distinct word are worked out once and kept."""
        w = self.w.reshape(len(self.OFFSETS), FEATURES, len(LABELS))
        keys, where, back = np.unique(t.hashes(), return_index=True, return_inverse=True)
        if self.kept is None or len(self.kept[0]) > KEPT_WORDS:
            self.kept = np.zeros(0, np.uint64), np.zeros((len(w), 0, len(LABELS)))
        known, scores = self.kept
        at = np.searchsorted(known, keys)
        new = np.ones(len(keys), bool)
        new[at < len(known)] = known[at[at < len(known)]] != keys[at < len(known)]
        if new.any():
            raw = t.data.tobytes()
            words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(t.starts[where[new]].tolist(), t.ends[where[new]].tolist())]
            ids = np.array([[_feature(f) for f in shape(x)] for x in words])
            known, scores = np.insert(known, at[new], keys[new]), np.insert(scores, at[new], w[:, ids].sum(2), axis=1)
            self.kept = known, scores
        own = np.searchsorted(known, keys)[back.reshape(-1)]
        row, out = t.words_of(), np.zeros((len(own), len(LABELS)))
        for k, off in enumerate(self.OFFSETS):
            place = np.arange(len(own)) + off
            ok = (place >= 0) & (place < len(own))
            ok[ok] = row[place[ok]] == row[ok]
            none = w[k, 0] * ids_per_word()
            out += np.where(ok[:, None], scores[k][own[np.where(ok, place, 0)]], none)
        return out

    def viterbi(self, u: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The best labels of all words, given their scores and each text's place among them."""
        out, size = np.zeros(len(u), np.int64), np.diff(bounds)
        order = [i for i in np.argsort(size, kind="stable").tolist() if size[i]]
        while order and size[order[-1]] > LONG_TEXT:
            i = order.pop()
            out[bounds[i]:bounds[i + 1]] = self._long(u[bounds[i]:bounds[i + 1]])
        while order:
            top, some = int(size[order[-1]]), []
            while order and top * (len(some) + 1) <= max(DECODE_WORDS, top):
                some.append(order.pop())
            mask = np.arange(top) < size[some][:, None]
            at = np.where(mask, bounds[some][:, None] + np.arange(top), 0)
            best, back = self._forward((self.s + u[at[:, 0]])[:, None], u[at], mask)
            out[at[mask]] = _trace(back, np.zeros(len(some), np.int64), best[:, 0].argmax(1))[mask]
        return out

    def _forward(self, best: np.ndarray, u: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(rows, starts, labels): the scores of the best paths from each start to each
        label after a row's last word, and of each further word where they come from."""
        back = []
        for t in range(1, u.shape[1]):
            step = best[:, :, :, None] + self.t
            from_ = step.argmax(2)
            new = np.take_along_axis(step, from_[:, :, None], 2)[:, :, 0] + u[:, t, None]
            go = mask[:, t, None, None]
            back.append(np.where(go, from_, np.arange(len(LABELS))).astype(np.int8))
            best = np.where(go, new, best)
        return best, back

    def _long(self, u: np.ndarray) -> np.ndarray:
        """The best labels of one long text, its blocks worked on at once."""
        k, blocks = len(LABELS), -(-len(u) // BLOCK)
        mask = (np.arange(blocks * BLOCK) < len(u)).reshape(blocks, BLOCK)
        padded = np.zeros((blocks * BLOCK, k))
        padded[: len(u)] = u
        padded = padded.reshape(blocks, BLOCK, k)
        begin = self.t + padded[:, 0, None]  # from each label that may come before
        begin[0] = self.s + padded[0, 0]
        best, back = self._forward(begin, padded, mask)
        total, came = best[0, 0], np.zeros((blocks, k), np.int64)
        for b in range(1, blocks):
            paths = total[:, None] + best[b]
            came[b] = paths.argmax(0)
            total = paths.max(0)
        start, end = np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)
        end[-1] = total.argmax()
        for b in range(blocks - 1, 0, -1):
            start[b] = end[b - 1] = came[b, end[b]]
        return _trace(back, start, end)[mask]


def _trace(back: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The labels of each row's path from ``start`` that ends in ``end``."""
    rows = np.arange(len(end))
    path = np.zeros((len(end), len(back) + 1), np.int64)
    path[:, -1] = end
    for t in range(len(back), 0, -1):
        path[:, t - 1] = back[t - 1][rows, start, path[:, t]]
    return path


def ids_per_word() -> int:
    return len(shape("x"))


def labelled_examples(table: str = EXAMPLES) -> tuple[list[list[str]], list[np.ndarray]]:
    words, gold = [], []
    for line in table.splitlines():
        seg, lab = [], []
        for part in re.split(r"(\{(?:email|phone|id) [^}]*\})", line):
            m = re.fullmatch(r"\{(email|phone|id) ([^}]*)\}", part)
            for k, w in enumerate(_WORD.findall(m[2] if m else part)):
                if not m and not core(w)[1] or (not m and seg and re.fullmatch(r"[.,]+", w)):
                    continue
                seg.append(w)
                lab.append(LABELS.index(("I-" if k else "B-") + m[1]) if m else 0)
        if seg:
            words.append(seg)
            gold.append(np.array(lab))
    return words, gold


def train(table: str = EXAMPLES) -> Crf:
    crf = Crf().fit(*labelled_examples(table))
    crf.ids.clear()
    return crf


def crf_spans(crf: Crf, column: pa.Array) -> list[list[tuple[int, int, int]]]:
    """(start, end, kind) of each text by the CRF; runs of B and I labels of one kind."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(column))]
    kinds = {"email": 4, "phone": 5, "id": 6}
    wanted = np.flatnonzero([t is not None and _TRIGGER.search(t) is not None for t in column.to_pylist()])
    for t in cut_texts(column.take(pa.array(wanted))):
        labels = crf.viterbi(crf.unary(t), t.row_word)
        raw, row = t.data.tobytes(), t.words_of()
        inner = np.concatenate([[0], np.cumsum((t.data & 0xC0) == 0x80)])  # bytes that begin no code point
        for k in np.flatnonzero(_BEGINS[labels]).tolist():
            i, e = int(row[k]), k + 1
            while e < len(labels) and row[e] == i and labels[e] == labels[k] + 1:
                e += 1
            words = [raw[t.starts[j]:t.ends[j]].decode("utf-8", "replace") for j in (k, e - 1)]
            base = int(t.bounds[i])
            place = lambda byte: int(byte - base - (inner[byte] - inner[base]))  # noqa: E731, B023
            a = place(t.starts[k]) + core(words[0])[0]
            b = place(t.starts[e - 1]) + core(words[1])[1]
            text = raw[t.starts[k]:t.ends[e - 1]].decode("utf-8", "replace")
            found = _WHITE.sub(" ", text[core(words[0])[0]:b - place(t.starts[k])])
            name, n = LABELS[labels[k]][2:], sum(c.isdecimal() for c in found)
            if name == "email" and " dot" in found.lower().replace("(", " ").replace("[", " ") or \
                    name == "phone" and 7 <= n <= 15 or name == "id" and 6 <= n <= 30:
                out[wanted[t.first + i]].append((a, b, kinds[name]))
    return out


def find(docs: DataFrame, crf: Crf | None = None, text: str = "text") -> DataFrame:
    """``docs`` without the text and with ``found``: array of (start, end, kind),
    the base spans and those that the CRF adds, by start, then kind."""
    small_batches(docs.sparkSession)
    docs = without(docs, "found")
    crf = crf or train()
    place = docs.columns.index(text)
    names = [c for c in docs.columns if c != text]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            rows = []
            for t, more in zip(texts, crf_spans(crf, batch.column(place))):
                base = base_spans(t)
                free = [s for s in more if not any(a < s[1] and s[0] < b for a, b, _ in base)]
                rows.append([{"start": a, "end": b, "kind": k} for a, b, k in sorted(base + free, key=lambda s: (s[0], s[2]))])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(rows, kind)], names=[*names, "found"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != text)
    return docs.mapInArrow(task, f"{schema}found array<struct<start:bigint,end:bigint,kind:int>>")
