"""Repairing text from scanned pages.

Two passes over the blocks.  The first counts words, pairs of neighbouring words and letter skeletons of the
whole corpus, exactly, in one shuffle by key.  What is rarer than one in 2^24 words counts as unseen at every size of the
corpus, so the table that the second pass carries has at most 3 x 2^24 keys of 14 bytes, of natural text some per
cent of that.  Words next to a line end are not counted, since they may be halves.  The probabilities of the single
confusions are learned from the words of the corpus by expectation maximisation.

The second pass reads every block.  A word is suspicious when it is rare within its skeleton, the form that all
look-alike characters share.  Lines with suspicious words are decoded by Viterbi over candidate words: the
probability of each character confusion times the corpus likelihood of words and word pairs.  Halves of words
at a line end are joined when the whole is likelier than the halves.  Page numbers are told by their form,
running headers by belonging to the headers that the same document has on its other pages.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.whitespace import LINE_ENDS
from quire.plans.materialize import join_checked, materialize, once, spread

#: Look-alikes as they appear, and what they stand for.
CONFUSIONS = (
    ("c", "e"), ("f", "t"), ("5", "s"), ("l", "i"), ("ri", "n"), ("0", "o"), ("1", "l"), ("1", "i"), ("cl", "d"), ("ii", "u"),
    ("rn", "m"), ("li", "h"), ("vv", "w"), ("9", "g"), ("6", "b"), ("8", "b"), ("m", "rn"), ("d", "cl"),
)
#: Letters in place of digits.
DIGIT_CONFUSIONS = (("o", "0"), ("l", "1"), ("i", "1"), ("s", "5"), ("b", "8"), ("b", "6"), ("z", "2"), ("g", "9"))
ALL_CONFUSIONS = CONFUSIONS + DIGIT_CONFUSIONS
#: The digits that a letter may stand for, each with its place among all confusions.
DIGITS_OF = {letter: [(d, len(CONFUSIONS) + i) for i, (x, d) in enumerate(DIGIT_CONFUSIONS) if x == letter] for letter, _ in DIGIT_CONFUSIONS}
#: Every look-alike maps to what it shares with its original.
SKELETON = str.maketrans({"m": "rri", "n": "ri", "d": "ei", "u": "ii", "h": "ii", "w": "vv", "c": "e", "f": "t", "5": "s", "l": "i", "1": "i", "0": "o", "9": "g", "6": "b", "8": "b"})

#: How readily a word is taken for a misreading; the probability of an average confusion.
P_CONFUSION = 0.02
P_CUT = 0.001
RARE = 0.03
#: Discount of a word as read: its own occurrence is no evidence for it.
ONCE = 0.9
MEMO = 500_000

#: Words, pairs and skeletons of a smaller share of all words count as unseen.
RAREST = 1 / (1 << 24)
#: Rounds of expectation maximisation; confusions that the mean rate would give, added to the expected ones; how far a probability may be from the average.
ROUNDS, PRIOR, FARTHEST = 2, 20.0, 8.0

#: Zero width space and byte order mark.
_INVISIBLE = (chr(0x200B), chr(0xFEFF))
_HYPHENS, _QUOTES, _SOFT = (chr(0x2010), chr(0x2011)), tuple(map(chr, (0x2018, 0x2019, 0xB4, 0x60))), chr(0xAD)
_WORD = re.compile("[^\\s.,;:()\\[\\]{}*\"!?…“”«»|<>_=+]+")
_LINES = re.compile(f"\r\n|[{LINE_ENDS}]")
_MARK = "-" + "".join(map(chr, (0x2010, 0x2011, 0xAC, 0xAD)))
_CLOSING = ".,;:!?)]}\"”»|"
_EDGE = ".,;:()[]{}*\"!?…“”«»|<>_=+‘’'" + _MARK

_NUMBER = r"(?:(?=[0-9oOlISsBbZ]*[0-9])[0-9oOlISsBbZ]{1,5}|(?=[ivxlcdm])(?:x{0,3}(?:ix|iv|v?i{0,3}))|(?=[IVXLCDM])(?:X{0,3}(?:IX|IV|V?I{0,3})))"
PAGE_NUMBER = re.compile(rf"(?:[-–—\[(|]\s*)?(?:(?:[Pp][aoq0]?[gq9]?[ec]?\.?|PAGE|[Ff]olio|[Ss]eite|[Pp][áa]gina)\s*)?{_NUMBER}(?:\s*(?:of|de|sur|von|/)\s*{_NUMBER})?(?:\s*[-–—\])|])?")
_FIRST_NO = re.compile(rf"{_NUMBER}\s*[|·•–—-]\s+")
_LAST_NO = re.compile(rf"\s+(?:[|·•–—-]\s*)?{_NUMBER}$")


def lines_of(text: str) -> list[str]:
    if not text.isascii():
        for c in _INVISIBLE:
            text = text.replace(c, "")
    return _LINES.split(text)


def words_of(line: str) -> list[str]:
    """Lower-case words without punctuation; hyphens and apostrophes inside a word stay."""
    if not line.isascii():
        line = line.replace(_SOFT, "")
        for c in _HYPHENS:
            line = line.replace(c, "-")
        for c in _QUOTES:
            line = line.replace(c, "'")
    return _WORD.findall(line.lower())


def header_keys(line: str) -> list[str]:
    """Skeletons of a header line: as it is, and without a page number before or after it."""
    plain = " ".join(line.split())
    forms = {plain, _FIRST_NO.sub("", plain, count=1), _LAST_NO.sub("", plain)}
    return sorted({"".join(f.lower().translate(SKELETON).split()) for f in forms if len(f) >= 4})


def around(lines: list[str], k: int, block) -> list[str]:
    """Skeletons of the words before and after a line; the block's id where the text ends."""
    before = next((w[-1] for i in range(k - 1, -1, -1) if (w := words_of(lines[i]))), f"{block}")
    after = next((w[0] for i in range(k + 1, len(lines)) if (w := words_of(lines[i]))), f"{block}")
    return [before.translate(SKELETON), after.translate(SKELETON)]


def looks_like_header(line: str) -> bool:
    """Few words, most of them capitalised or numbers, and no punctuation at the end."""
    plain = line.strip()
    if len(plain) > 90 or plain[-1] in ".,;:!?" or plain[0].islower():
        return False
    parts = plain.split()
    if len(parts) > 9:
        return False
    return 2 * sum(p[0].isupper() or p[0].isdigit() or p[0] == "|" for p in parts) > len(parts)


def is_page_number(line: str) -> bool:
    plain = line.strip()
    return 0 < len(plain) <= 24 and PAGE_NUMBER.fullmatch(plain) is not None


# --- first pass -------------------------------------------------------------------------------------------------


def corpus_counts(rows: DataFrame) -> DataFrame:
    """word, h, n: how often each word, skeleton ('s') and pair ('p') occurs, by the hash of its key; words are named."""

    def emit(words: Counter, pairs: Counter):
        skeletons: Counter = Counter()
        for w, n in words.items():
            skeletons[w.translate(SKELETON)] += n
        keys = [*("w" + w for w in words), *("s" + k for k in skeletons), *(f"p{a} {b}" for a, b in pairs)]
        named = [*words, *[None] * (len(skeletons) + len(pairs))]
        n = [*words.values(), *skeletons.values(), *pairs.values()]
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(named, pa.string()), pa.array(hashes), pa.array(n, pa.int64())], names=["word", "h", "n"])

    def run(batches):
        words: Counter = Counter()
        pairs: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                lines = lines_of(text.as_py())
                last = len(lines) - 1
                for k, line in enumerate(lines):
                    w = words_of(line)
                    w = w[k > 0 : len(w) - (k < last)]
                    words.update(w)
                    w = ["#" if x.isdecimal() else x for x in w]
                    pairs.update(zip(w, w[1:]))  # noqa: B905
            if len(pairs) > MEMO:
                yield from emit(words, pairs)
                words.clear()
                pairs.clear()
        yield from emit(words, pairs)

    return rows.mapInArrow(run, "word string, h long, n long").groupBy("word", "h").agg(F.sum("n").alias("n"))


def table_of(hashes: np.ndarray, n: np.ndarray) -> dict:
    """Keys in the order of their hashes, their counts, and where the keys of each run of leading bits begin."""
    order = np.argsort(hashes)
    keys = hashes[order]
    bits = max(1, int(len(keys)).bit_length())
    starts = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.float64) * 2.0 ** (64 - bits))
    starts[-1] = len(keys)
    return {"keys": keys, "n": n[order].astype(np.float32), "starts": starts.astype(np.uint32), "shift": 64 - bits}


def learn(rows: DataFrame) -> dict:
    """The language model and the channel of all passages."""
    passages = rows.filter(~F.coalesce(F.col("block_type"), F.lit("")).isin("page_header", "page_footer")).select("body")
    counts = materialize(corpus_counts(passages))
    word, n = F.col("word"), F.col("n")
    total, numbers = counts.agg(F.sum(F.when(word.isNotNull(), n)), F.sum(F.when(word.rlike(r"\A\p{Nd}+\z"), n))).first()
    total = float(total or 0)
    held = counts.filter(n >= RAREST * total).select("h", "n").toArrow()  # words, pairs, skeletons: at most 1 / RAREST each
    learned = table_of(held.column("h").to_numpy().view(np.uint64), held.column("n").to_numpy())
    learned |= {"total": total, "numbers": float(numbers or 0), "unit": max(1.0, RAREST * total), "channel": None}
    return learned | {"channel": channel(counts.filter(word.isNotNull()).select("word", "n"), learned)}


def channel(words: DataFrame, learned: dict) -> list[float]:
    """The probability of every confusion of ALL_CONFUSIONS, from all different words and their counts.

    Expectation: for each suspicious word the share of each candidate, by its count and the channel.  Maximisation: what
    a confusion is expected to have happened per occurrence of what it stands for, relative to the mean of all.
    """
    size = len(ALL_CONFUSIONS)
    chances: list[float] | None = None
    for _ in range(ROUNDS):
        shared = words.sparkSession.sparkContext.broadcast(learned | {"channel": chances})

        def run(batches, shared=shared):
            model = Model(shared.value)
            happened, could = np.zeros(size), np.zeros(size)
            for batch in batches:
                for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for c, (_, true) in enumerate(ALL_CONFUSIONS):
                        if true in w:
                            could[c] += n * w.count(true)
                    if model.suspicious(w):
                        options = [(model.p(y) * math.exp(p), used) for y, p, used in model.odd[w]]
                        every = sum(q for q, _ in options) + model.p(w, True)
                        for q, used in options:
                            for c in used:
                                happened[c] += n * q / every
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(happened), pa.array(could)], names=["c", "happened", "could"])

        sums = words.mapInArrow(run, "c int, happened double, could double").groupBy("c").agg(F.sum("happened"), F.sum("could")).collect()  # one row per confusion
        happened, could = (sum(r[k] for r in sums) for k in (1, 2))
        mean = happened / could if could else 0.0
        if not mean:
            break
        rates = {r[0]: (r[1] + PRIOR) / (r[2] + PRIOR / mean) / mean for r in sums}
        chances = [P_CONFUSION * min(FARTHEST, max(1 / FARTHEST, rates.get(c, 1.0))) for c in range(size)]
    return chances or [P_CONFUSION] * size


# --- second pass ------------------------------------------------------------------------------------------------


class Model:
    """Language model and channel, with memory for words already judged."""

    def __init__(self, learned: dict):
        self.keys, self.n, self.starts = (memoryview(learned[k]) for k in ("keys", "n", "starts"))
        self.shift = learned["shift"]
        self.total, self.numbers, self.unit = max(1.0, learned["total"]), learned["numbers"], learned["unit"]
        self.steps = [math.log(p) for p in learned["channel"] or [P_CONFUSION] * len(ALL_CONFUSIONS)]
        self.counts: dict[str, float] = {}
        self.known: set[str] = set()
        self.odd: dict[str, list[tuple[str, float, tuple[int, ...]]]] = {}
        self.plain: dict[str, str] = {}

    def count(self, key: str) -> float:
        n = self.counts.get(key)
        if n is None:
            if len(self.counts) > MEMO:
                self.counts.clear()
            h = xxhash.xxh64_intdigest(key)
            first = h >> self.shift
            n = 0.0
            for i in range(self.starts[first], self.starts[first + 1]):
                if self.keys[i] == h:
                    n = self.n[i]
                    break
            self.counts[key] = n
        return n

    def bare(self, token: str) -> str:
        """The word in a token as printed; words are parted by spaces if it holds several."""
        b = self.plain.get(token)
        if b is None:
            if len(self.plain) > MEMO:
                self.plain.clear()
            b = self.plain[token] = " ".join(words_of(token))
        return b

    def word(self, w: str) -> float:
        """Corpus count of a word; a number never seen counts as one of its length."""
        n = self.count("w" + w)
        return n or (self.numbers / 10 ** len(w) if w.isdecimal() else 0.0)

    def candidates(self, w: str, edits: int = 2) -> list[tuple[str, float, tuple[int, ...]]]:
        """(word of the corpus, log probability that it was read as ``w``, confusions that lead there), without ``w`` itself."""
        reached: dict[str, tuple[float, tuple[int, ...]]] = {w: (0.0, ())}
        front = [w]
        for _ in range(edits if len(w) <= 24 else 1):
            fresh = []
            for x in front:
                so_far, used = reached[x]
                for c, (seen, true) in enumerate(CONFUSIONS):
                    i = x.find(seen)
                    while i >= 0:
                        y = x[:i] + true + x[i + len(seen) :]
                        p = so_far + self.steps[c]
                        if y not in reached:
                            fresh.append(y)
                            reached[y] = (p, (*used, c))
                        elif p > reached[y][0]:
                            reached[y] = (p, (*used, c))
                        i = x.find(seen, i + 1)
            front = fresh
        if len(w) <= 12 and any(c in DIGITS_OF for c in w):
            forms: list[tuple[str, float, tuple[int, ...]]] = [("", 0.0, ())]
            for x in w:
                ways = [(x, 0.0, ())] if x.isdigit() else [(d, self.steps[c], (c,)) for d, c in DIGITS_OF.get(x, ())]
                forms = [(f + d, p + q, (*used, *more)) for f, p, used in forms for d, q, more in ways][:64]
            for f, p, used in forms:
                if used and p > reached.get(f, (-99.0,))[0]:
                    reached[f] = (p, used)
        del reached[w]
        return [(y, p, used) for y, (p, used) in reached.items() if self.word(y) > 0]

    def suspicious(self, w: str) -> bool:
        """Judges a word once; the candidates of a suspicious one are kept in ``odd``."""
        if w in self.odd:
            return True
        if len(self.known) > MEMO:
            self.known.clear()
        if len(self.odd) > MEMO:
            self.odd.clear()
        if not w.isdecimal():
            n, same = self.count("w" + w), self.count("s" + w.translate(SKELETON))
            digits = any(c.isdigit() for c in w)
            if n - ONCE < RARE * same or (digits and n <= 2 * self.unit):
                found = self.candidates(w)
                if found:
                    self.odd[w] = found
                    return True
        self.known.add(w)
        return False

    def p(self, w: str, own: bool = False) -> float:
        """Probability of a word; as read, a word seen once may be that very error."""
        n = self.word(w)
        if own:
            # a number with a letter in it is seldom a word of its own
            n = max(n - 2, 0.002 * self.unit) if any(c.isdigit() for c in w) else max(n - ONCE, 0.02 * self.unit)
        return max(n, 0.002 * self.unit) / self.total

    def pair(self, a: str, b: str) -> float:
        """Corpus count of two neighbouring words; all numbers are alike here."""
        return self.count(f"p{'#' if a.isdecimal() else a} {'#' if b.isdecimal() else b}")

    def step(self, a: str | None, b: str, own_a: bool, own_b: bool) -> float:
        """log P(b | a), pairs and single words interpolated; numbers share their class among its members."""
        single = self.p(b, own_b)
        if a is None:
            return math.log(single)
        both = self.pair(a, b)
        if own_a or own_b:
            both = max(0.0, both - 1.0)
        if b.isdecimal() and self.numbers:
            both *= min(1.0, self.word(b) / self.numbers)
        seen = self.numbers if a.isdecimal() else self.word(a)
        return math.log(0.7 * both / max(seen, both, 1.0) + 0.3 * single)

    def decode(self, line: list[str]) -> list[str]:
        """The likeliest true words of a line."""
        states: list[tuple[str | None, float, int | None, bool]] = [(None, 0.0, None, False)]
        history = []
        for w in line:
            found = self.odd.get(w)
            options = [(w, math.log(1 - P_CONFUSION), found is not None)] + [(y, p, False) for y, p, _ in found or ()]
            new = []
            for true, channel, own in options:
                scores = [score + self.step(before, true, own_a, own) for before, score, _, own_a in states]
                best = max(range(len(scores)), key=scores.__getitem__)
                new.append((true, scores[best] + channel, best, own))
            history.append(new)
            states = new
        out, i = [], max(range(len(states)), key=lambda i: states[i][1])
        for layer in reversed(history):
            out.append(layer[i][0])
            i = layer[i][2]
        return out[::-1]

    def corrected(self, w: str) -> str:
        """The likeliest true form of a word by itself."""
        return self.decode([w])[0] if w not in self.known and self.suspicious(w) else w

    def cut(self, end: str, a: str, b: str) -> str | None:
        """Whether the words ``a`` and ``b`` around a line end are halves of one word: the word, or None.

        ``end`` is the last character of the line.  A compound that breaks at its own hyphen is no cut.
        """
        marked = end in _MARK
        if marked:
            a = a.rstrip(_MARK)
        elif end in _CLOSING:
            return None
        if not a or not b or not a[-1].isalnum() or not b[0].isalnum() or a.isdecimal() or b.isdecimal():
            return None
        joined = a + b
        n = self.word(joined)
        pair = 0.0 if marked else self.pair(a, b) + self.word(a) * self.word(b) / self.total
        if not marked and (n or self.total * P_CONFUSION) * P_CUT <= pair:
            return None
        if not n:
            better = self.corrected(joined)
            n = self.word(better) * P_CONFUSION if better != joined else 0.0
        if marked:
            compound = f"{a}-{b}"
            whole = self.word(compound) or (self.word(self.corrected(compound)) * P_CONFUSION)
            if whole or n:
                return joined if n > whole else None
            apart = min(self.word(a), self.word(b))
            return None if apart > 0 else joined
        return joined if n * P_CUT > pair and n > 0 else None


class Reader:
    """What the second pass finds in one block."""

    def __init__(self, model: Model):
        self.model = model

    def split(self, lines: list[str]) -> tuple[list[int], list[int], list[int]]:
        """Indexes of the lines that belong to the passage, that are page numbers, and that may be headers."""
        body, numbers, headers = [], [], []
        for k, line in enumerate(lines):
            if not line.strip():
                continue
            if is_page_number(line) and not self.runs_on(lines, k):
                numbers.append(k)
            elif looks_like_header(line):
                headers.append(k)
            else:
                body.append(k)
        return body, numbers, headers

    def runs_on(self, lines: list[str], k: int) -> bool:
        """Whether a line that is only a number belongs to the sentence around it."""
        if not 0 < k < len(lines) - 1 or not lines[k].strip().isdecimal():
            return False
        before, after = words_of(lines[k - 1]), words_of(lines[k + 1])
        if not before or not after:
            return False
        pair = self.model.pair
        return pair(before[-1], after[0]) == 0 and pair(before[-1], "#") > 0 and pair("#", after[0]) > 0

    def damage(self, lines: list[str], body: list[int]) -> tuple[bool, bool]:
        """(a word is cut, a word is misread) in the lines of a passage."""
        model, known, cut, misread = self.model, self.model.known, False, False
        words = [words_of(lines[k]) for k in body]
        for i, tokens in enumerate(words):
            if i + 1 < len(words) and tokens and words[i + 1]:
                end = lines[body[i]].rstrip()[-1]
                whole = model.cut(end, tokens[-1], words[i + 1][0])
                if whole is not None:
                    cut = True
                    del tokens[-1], words[i + 1][0]
                    misread = misread or model.corrected(whole) != whole
                elif end in _MARK and tokens[-1][:-1]:
                    # a compound that breaks at its own hyphen is judged as one word
                    tokens[-1] = tokens[-1].rstrip("-") + "-" + words[i + 1].pop(0)
            if not misread:
                odd = [w for w in tokens if w not in known and model.suspicious(w)]
                if odd:
                    misread = model.decode(tokens) != tokens
        return cut, misread


FOUND = "block_id long, document_id string, kind string, keys array<string>, around array<string>, body string"


def scan(rows: DataFrame, learned: dict, words: bool = True) -> DataFrame:
    """block_id, document_id, kind, keys, around, body.

    kind is 'hyphen', 'misread', 'inline' or 'furniture' where certain; 'inline?', 'furniture?' and 'heading?' with the keys
    of lines that are damage if the document has such a header, and with the words around a line that is evidence for a header itself; 'header' with the keys of a typed header; 'passage?' with
    the text of a block whose words can be judged only when it is known which of its lines are headers.  Without ``words`` only headers and page numbers are looked for.
    """
    shared = rows.sparkSession.sparkContext.broadcast(learned)

    def run(batches):
        reader = Reader(Model(shared.value))
        for batch in batches:
            out: tuple[list, list, list, list, list, list] = ([], [], [], [], [], [])

            def add(block, doc, kind, keys=None, around=None, body=None, out=out):
                for c, v in zip(out, (block, doc, kind, keys, around, body), strict=True):
                    c.append(v)

            for block, doc, kind, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                lines = lines_of(text.as_py())
                filled = [x for x in lines if x.strip()]
                if not filled:
                    continue
                if kind in ("page_header", "page_footer"):
                    if not is_page_number(filled[0]):
                        add(block, doc, "header", header_keys(filled[0]))
                    continue
                if len(filled) == 1 and is_page_number(filled[0]):
                    add(block, doc, "furniture")
                    continue
                if len(filled) == 1 and looks_like_header(filled[0]):
                    add(block, doc, "heading?" if kind == "section_header" else "furniture?", header_keys(filled[0]), [f"{block}"] * 2)
                body, numbers, headers = reader.split(lines)
                if len(filled) == 1:
                    body, numbers, headers = [k for k, x in enumerate(lines) if x.strip()], [], []
                if numbers and (body or headers):
                    add(block, doc, "inline")
                for k in headers:
                    # the lines of a key-value block are its fields
                    add(block, doc, "inline?", header_keys(lines[k]), None if kind == "key_value_item" else around(lines, k, block))
                if not words:
                    continue
                if headers:
                    add(block, doc, "passage?", body=text.as_py())
                    continue
                cut, misread = reader.damage(lines, body)
                if cut:
                    add(block, doc, "hyphen")
                if misread:
                    add(block, doc, "misread")
            types = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["block_id", "document_id", "kind", "keys", "around", "body"])

    return rows.mapInArrow(run, FOUND)


def judged(passages: DataFrame, learned: dict) -> DataFrame:
    """block_id, kind: 'hyphen' and 'misread' of passages (block_id, body, drop) without the lines of the headers ``drop``."""
    shared = passages.sparkSession.sparkContext.broadcast(learned)

    def run(batches):
        reader = Reader(Model(shared.value))
        for batch in batches:
            blocks, kinds = [], []
            for block, text, drop in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                lines = lines_of(text.as_py())
                body, _, headers = reader.split(lines)
                gone = set(drop or ())
                kept = [k for k in headers if not gone.intersection(header_keys(lines[k]))]
                for kind, there in zip(("hyphen", "misread"), reader.damage(lines, sorted(body + kept)), strict=True):
                    if there:
                        blocks.append(block)
                        kinds.append(kind)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(kinds, pa.string())], names=["block_id", "kind"])

    return passages.mapInArrow(run, "block_id long, kind string")


def text_blocks(blocks: DataFrame, *more: str) -> DataFrame:
    return blocks.select(F.col("id").cast("long").alias("block_id"), "document_id", "block_type", F.col("text_content").alias("body"), *more).filter(F.length("body") > 0)


def confirmed_keys(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(document_id, key) of the documents' headers, typed or repeated; (block_id, document_id, kind, key) of the lines in question.

    A line is repeated if it occurs in two blocks, as a block or within a passage, between other words each time
    (copies of one passage have the same words there).  Headings alone are no evidence.
    """
    typed = found.filter("kind = 'header'").select("document_id", F.explode("keys").alias("key")).distinct()
    seen = found.filter("around IS NOT NULL").select("block_id", "document_id", "kind", F.col("around")[0].alias("before"), F.col("around")[1].alias("after"), F.explode("keys").alias("key"))
    # two of a kind are enough, and smallest and largest tell whether there are two
    two = F.lit(True)
    for c in ("block_id", "before", "after"):
        two = two & (F.min(c) < F.max(c))
    again = seen.groupBy("document_id", "key").agg((two & (F.count_if(F.col("kind") != "heading?") > 0)).alias("repeated")).filter("repeated").select("document_id", "key")
    headers = typed.unionByName(again).distinct()
    asked = found.filter(F.col("kind").isin("inline?", "furniture?", "heading?")).select(
        "block_id", "document_id", F.when(F.col("kind") == "inline?", "inline").otherwise("furniture").alias("kind"), F.explode("keys").alias("key")
    )
    return headers, asked


def damage(blocks: DataFrame) -> DataFrame:
    """block_id, kind: one row for each block and kind of damage in its text.

    ``blocks`` needs id, document_id, block_type and text_content; other columns are ignored.  Null and empty
    texts and typed headers and footers have no rows; a block that occurs in several rows counts once.
    """
    rows = text_blocks(blocks)
    learned = learn(rows)
    found = materialize(scan(rows, learned))
    headers, asked = confirmed_keys(found)
    sure = found.filter(F.col("kind").isin("hyphen", "misread", "inline", "furniture")).select("block_id", "kind")
    known = materialize(asked.join(headers, ["document_id", "key"], "left_semi"))
    drop = known.filter("kind = 'inline'").groupBy("block_id").agg(F.collect_set("key").alias("drop"))  # keys of one block
    open_ = found.filter("kind = 'passage?'").select("block_id", "body")
    passages = join_checked(open_, drop, ["block_id"], "left", 128).select("block_id", "body", "drop")
    out = sure.unionByName(known.select("block_id", "kind")).unionByName(judged(passages, learned)).distinct()
    whole = out.filter("kind = 'furniture'").select("block_id")
    # a block that is furniture as a whole has no passage that could be damaged
    return out.filter("kind = 'furniture'").unionByName(out.filter("kind <> 'furniture'").join(whole, "block_id", "left_anti"))


def repaired(blocks: DataFrame) -> DataFrame:
    """block_id, document_id, page_number, passage: the readable passages without scan damage.

    Headers, footers and page numbers, as blocks or as lines, are gone, halves of words joined, misread words
    replaced (in the case of the word as read) and lines run together into paragraphs; blank lines part paragraphs.
    A block that occurs in several identical rows gives one.  Order by block_id reads a document.
    """
    rows = text_blocks(blocks, "page_number").filter(~F.coalesce(F.col("block_type"), F.lit("")).isin("page_header", "page_footer"))
    rows = once(rows.select("block_id", "document_id", F.col("page_number").cast("int").alias("page_number"), "body"), "block_id")
    learned = learn(text_blocks(blocks))
    headers, asked = confirmed_keys(materialize(scan(text_blocks(blocks), learned, words=False)))
    lines = asked.join(headers, ["document_id", "key"], "left_semi").groupBy("block_id").agg(F.collect_set("key").alias("drop"))  # keys of one block
    shared = rows.sparkSession.sparkContext.broadcast(learned)

    def run(batches):
        reader = Reader(Model(shared.value))
        for batch in batches:
            kept, texts = [], []
            for r, (body, drop) in enumerate(zip(batch.column(3), batch.column(4).to_pylist(), strict=True)):
                text = repair(reader.model, body.as_py(), set(drop or ()))
                if text:
                    kept.append(r)
                    texts.append(text)
            part = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(texts, pa.string())], names=["block_id", "document_id", "page_number", "passage"])

    joined = join_checked(rows, lines, ["block_id"], "left", 128).select("block_id", "document_id", "page_number", "body", "drop")
    return joined.mapInArrow(run, "block_id long, document_id string, page_number int, passage string")


def repair(model: Model, text: str, drop: set[str]) -> str:
    """The readable form of one block; '' if nothing of it is passage."""
    paragraphs: list[list[str]] = [[]]
    lines, reader = lines_of(text), Reader(model)
    single = sum(1 for x in lines if x.strip()) == 1
    for k, line in enumerate(lines):
        if not line.strip():
            paragraphs.append([])
        elif (is_page_number(line) and not reader.runs_on(lines, k)) or (drop and looks_like_header(line) and drop.intersection(header_keys(line))):
            if single:
                return ""
        else:
            paragraphs[-1].append(line)
    return "\n\n".join(x for x in (_run_on(model, p) for p in paragraphs if p) if x)


def _run_on(model: Model, lines: list[str]) -> str:
    tokens: list[str] = []
    for line in lines:
        parts = line.split()
        if tokens and parts:
            a, b = words_of(tokens[-1]), words_of(parts[0])
            whole = model.cut(tokens[-1][-1], a[-1], b[0]) if a and b else None
            if whole is not None:
                tokens[-1] = tokens[-1].rstrip(_MARK) + parts.pop(0)
            elif tokens[-1][-1:] in _MARK and parts[0][:1].isalnum() and tokens[-1][:-1][-1:].isalnum():
                tokens[-1] += parts.pop(0)
        tokens += parts
    bare = list(map(model.bare, tokens))
    known = model.known
    if [w for w in bare if w not in known and w and " " not in w and model.suspicious(w)]:  # judges every word
        judged = [i for i, w in enumerate(bare) if w and " " not in w]
        for i, true in zip(judged, model.decode([bare[i] for i in judged]), strict=True):
            if true != bare[i]:
                core = tokens[i].strip(_EDGE)
                at = tokens[i].find(core)
                shown = true.upper() if core.isupper() and len(core) > 1 and any(c.isalpha() for c in true) else true.capitalize() if core[:1].isupper() and true[:1].isalpha() else true
                tokens[i] = tokens[i][:at] + shown + tokens[i][at + len(core) :]
    return " ".join(tokens)


def _table(spark, sf_dir: str) -> DataFrame:
    from quire.sources.tables import read_table

    return spread(read_table(spark, sf_dir, "raw_blocks").select("id", "document_id", "block_type", "text_content", "page_number"))


def block_damage(spark, sf_dir: str) -> DataFrame:
    return damage(_table(spark, sf_dir))


def passages_repaired(spark, sf_dir: str) -> DataFrame:
    return repaired(_table(spark, sf_dir))
