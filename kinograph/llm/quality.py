"""Per-document text quality: lines labelled by a hidden Markov model, shares of the labels per document.

A document's lines are a sequence; each is in one of four states: prose,
list, table, junk.  The emission of a line is a small network over line
statistics (``line_statistics``), turned into a likelihood by the states'
shares; the transitions are counted.  Both are fitted on labelled documents:
a document's label is first given to all its lines, then lines are labelled
anew, as their document's form or as prose, by the model itself (Viterbi
training).  Documents are scored where they are read; no text is shuffled.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FORMS = ("prose", "list", "table", "junk")

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_TAG = re.compile(r"<[^<>]*>")
_MARK = re.compile(r"\s*(?:[-*+•·–—>]\s|\[[ xX]?\]\s|\(?\d{1,4}[.)\]:]\s|\(?[a-zA-Z][.)]\s|[A-Z][a-z]{0,2}\.\s*\d+\s|#)")
_SPOKEN = re.compile(r"\s*[-–—]\s")
#: Dots or dashes that lead to a short entry: inside of a piece, which goes on after them, and at its end.  A run is met once, at its first character, so that time is linear.
_LEADS_ON = re.compile(r"(?:(?<!\.)\.{3,}+|(?<!…)…{2,}+|(?<!_)_{3,}+|(?<!-)-{4,}+)\S")
_LEADS = re.compile(r"(?:\.{3}|…{2}|_{3}|-{4})\Z")
_FIELD = re.compile(r"^\s*[^\s:,.]{1,20}(?: [^\s:,.]{1,20})?\s?[:=]\s*\S")
_LONG_CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxz]{4,}", re.IGNORECASE)
#: The vowels of Latin script.
VOWELS = "aeiouyàâäáãåæéèêëíìîïóòôöõøœúùûüýÿ"
_INNER = re.compile(r"[.!?;:][\"'”’»)]*+\s++\S")
_NUMBER = re.compile(r"(?<!\S)[-+]?(?=[.,:%$€]*+\d)[\d.,:%$€]++(?!\S)")
_SHAPE = re.compile(r"[^\W\d_]++|\d++|\s++|(.)\1*+", re.DOTALL)

# What a character is, as bits.
_DIGIT, _UPPER, _BLANK, _SPACE, _HIGH, _ODD, _VOWEL, _ALNUM, _APOSTROPHE, _COMMA, _SEMICOLON, _TAB, _PIPE, _PART, _DASH, _SOLID = (1 << i for i in range(16))


class _Characters:
    """The bits of each code point, looked up when it is first met."""

    def __init__(self) -> None:
        self.bits = np.zeros(0x110000, np.int32)
        self.known = np.zeros(0x110000, bool)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        new = codes[~self.known[codes]]
        if len(new):
            for code in np.unique(new).tolist():
                ch = chr(code)
                self.known[code] = True
                self.bits[code] = (
                    ("0" <= ch <= "9") * _DIGIT | ch.isupper() * _UPPER | (ch == " ") * _BLANK | ch.isspace() * _SPACE
                    | ("\x80" <= ch <= "\xbf" or ch in "ÃÂâï€™œ�") * _HIGH | (ch > "~" and unicodedata.category(ch) in ("So", "Sk", "Cn", "Co", "Cc")) * _ODD
                    | (ch.lower() in VOWELS) * _VOWEL | ch.isalnum() * _ALNUM | (ch in "'’") * _APOSTROPHE | (ch == ",") * _COMMA | (ch == ";") * _SEMICOLON
                    | (ch == "\t") * _TAB | (ch == "|") * _PIPE | (ch in ",;|•·/\t") * _PART | (ch in "-–—") * _DASH | (not ch.isspace()) * _SOLID
                )
        return self.bits[codes]


class _Block:
    """Lines laid end to end as the bits of their characters, each line with an end mark of no bits."""

    def __init__(self, lines: Sequence[str], characters: _Characters) -> None:
        self.text = "\n".join(lines) + "\n"
        self.bits = characters(np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32))
        self.starts = np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines])[:-1]]) if lines else np.zeros(0, np.int64)
        if lines:
            self.bits[self.starts[1:] - 1] = 0
            self.bits[-1] = 0

    def per_line(self, mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, self.starts, dtype=np.int64)

    def count(self, bit: int) -> np.ndarray:
        return self.per_line(self.bits & bit != 0)

    def is_(self, bit: int) -> np.ndarray:
        return self.bits & bit != 0

    def line_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1

    def words(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(words, the line of each, the length of each): maximal runs of letters and digits, apostrophes between them included."""
        alnum = self.is_(_ALNUM)
        inside = alnum.copy()
        inside[1:-1] |= self.is_(_APOSTROPHE)[1:-1] & alnum[:-2] & alnum[2:]
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=np.int8(0)))  # the last character is an end mark
        starts, ends = edges[::2], edges[1::2]
        return _WORD.findall(self.text), self.line_of(starts), ends - starts

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of entries, most blanks in one) of each line: what separators leave that is not blank."""
        space, dash = self.is_(_SPACE), self.is_(_DASH)
        part = self.is_(_PART)
        part[1:-1] |= dash[1:-1] & space[:-2] & space[2:]
        first = np.zeros(len(part), bool)
        first[self.starts] = True
        first[1:] |= part[:-1] & ~part[1:]
        first &= ~part
        runs = np.flatnonzero(first)
        entries, most = np.zeros(len(self.starts), np.int64), np.zeros(len(self.starts), np.int64)
        if len(runs):
            solid = np.add.reduceat(self.is_(_SOLID) & ~part, runs, dtype=np.int64)
            blanks = np.add.reduceat(self.is_(_BLANK), runs, dtype=np.int64)
            keep = solid > 0
            line = self.line_of(runs)[keep]
            np.add.at(entries, line, 1)
            np.maximum.at(most, line, blanks[keep])
        return entries, most


def _leads(line: str) -> bool:
    """Whether dots or dashes lead to one to four pieces at the line's end."""
    if "..." not in line and "……" not in line and "___" not in line and "----" not in line:
        return False
    for after, piece in enumerate(reversed(line.rsplit(None, 5)[-5:])):
        if (after <= 3 and _LEADS_ON.search(piece)) or (1 <= after <= 4 and _LEADS.search(piece)):
            return True
    return False


def _ends_sentence(line: str) -> bool:
    """Whether a line ends in a full stop or its like, closing marks after it allowed, or in a quotation mark."""
    end = line.rstrip()
    return end[-1:] in ('"', "”", "»") or end.rstrip("\"'”’»)]")[-1:] in (".", "!", "?", "…")


#: The line statistics, in the order of ``line_statistics``.
STATISTICS = (
    "log_chars", "log_words", "mean_word_length", "long_words", "letters", "digits", "marks", "other_symbols", "high_latin", "spaces",
    "upper_letters", "capital_words", "common_words", "distinct_words", "number_tokens", "consonant_words", "vowels", "tag_chars", "tags_a_char",
    "ends_sentence", "inner_sentence", "commas_a_word", "opens_item", "opens_spoken", "opens_field", "leader", "wide_gaps", "tabs", "pipes",
    "tight_commas", "indent", "mixed_case_words", "like_last", "like_next", "length_like_last", "longest_word",
    "entry_words", "longest_entry", "semicolons_a_word",
)


class _WordKinds(dict):
    """What each word is, as bits: 1 long, 2 capital first, 4 common, 8 many consonants on end, 16 of mixed case.

    Words come again and again, so each is looked at once; the store is emptied when it holds ``most``.
    """

    def __init__(self, common: frozenset[str], most: int = 300_000) -> None:
        self.common, self.most = common, most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        kind = (
            (len(word) > 14)
            | word[0].isupper() << 1
            | (word.lower() in self.common) << 2
            | (_LONG_CONSONANTS.search(word) is not None) << 3
            | (word[1:].lower() != word[1:] and not word.isupper()) << 4
        )
        if len(word) <= 40:
            self[word] = kind
        return kind


def _skeleton(line: str) -> str:
    """The shape of a line's start: its first four runs, of letters, digits or spaces by kind, of another character as it is."""
    out = []
    for run in islice(_SHAPE.finditer(line), 4):
        ch = line[run.start()]
        out.append(ch if run.lastindex else "a" if ch.isalpha() else " " if ch.isspace() else "0")
    return "".join(out)


def line_statistics(docs: Sequence[Sequence[str]], kinds: _WordKinds, characters: _Characters) -> tuple[np.ndarray, np.ndarray]:
    """The STATISTICS of the non-blank lines of some documents, a row per line, and (words, letters in words, common words, ends a sentence)."""
    lines = [x for doc in docs for x in doc]
    if not lines:
        return np.zeros((0, len(STATISTICS)), np.float32), np.zeros((0, 4), np.int64)
    whole = _Block(lines, characters)
    tags = np.array([x.count("<") for x in lines])
    tagged = np.flatnonzero(tags).tolist()
    bare_lines, pieces = list(lines), list(lines)
    for i in tagged:
        bare_lines[i], pieces[i] = _TAG.sub(" ", lines[i]), _TAG.sub("|", lines[i])
    bare, piece = (_Block(bare_lines, characters), _Block(pieces, characters)) if tagged else (whole, whole)

    n = np.array([len(x) for x in lines])
    words, word_line, word_size = bare.words()
    kind = np.fromiter(map(kinds.__getitem__, words), np.int64, len(words))
    w = np.bincount(word_line, minlength=len(lines))
    m = np.maximum(w, 1)
    per_word = lambda x: np.bincount(word_line, weights=x, minlength=len(lines))
    letters = per_word(word_size)
    of_kind = {bit: per_word(kind & bit != 0) for bit in (1, 2, 4, 8, 16)}
    longest = np.zeros(len(lines), np.int64)
    np.maximum.at(longest, word_line, word_size)
    cuts = np.concatenate([[0], np.cumsum(w)]).tolist()
    distinct = np.array([len(set(words[a:b])) for a, b in zip(cuts, cuts[1:])])
    entries, most_blanks = piece.entries()

    spaces, digits, semicolons, commas = whole.count(_BLANK), whole.count(_DIGIT), bare.count(_SEMICOLON), bare.count(_COMMA)
    comma = bare.is_(_COMMA)
    tight = bare.per_line(np.concatenate([comma[:-1] & bare.is_(_SOLID)[1:], [False]])) if commas.any() else commas
    blank = whole.is_(_BLANK)
    # a gap: something, two blanks or more, something
    gaps = np.zeros(len(lines))
    if "  " in whole.text:
        gaps = whole.per_line(np.concatenate([[False, False], blank[1:-1] & blank[:-2] & whole.is_(_SOLID)[2:]]))
        gaps = gaps - np.array([x[0].isspace() and x[: len(x) - len(x.lstrip())].endswith("  ") for x in lines])
    bare_solid = bare.per_line(~bare.is_(_BLANK)) - 1  # without the end mark
    shapes = [_skeleton(x) for x in lines]
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    same_doc = doc[1:] == doc[:-1]
    same = np.array([a == b for a, b in zip(shapes, shapes[1:])], bool) & same_doc
    close = (np.abs(n[1:] - n[:-1]) <= 0.1 * n[1:]) & same_doc
    no = np.array([False])
    ends = np.array([_ends_sentence(x) for x in bare_lines])
    numbers = np.array([len(_NUMBER.findall(x)) if d else 0 for x, d in zip(bare_lines, digits.tolist())])
    by_line = lambda f: np.array([f(x) for x in lines])
    columns = (
        np.log1p(n) / 5,
        np.log1p(w) / 4,
        np.minimum(letters / m, 20) / 8,
        of_kind[1] / m,
        letters / n,
        digits / n,
        np.maximum(0, n - letters - spaces) / n,
        whole.count(_ODD) / n,
        whole.count(_HIGH) / n,
        spaces / n,
        whole.count(_UPPER) / np.maximum(1, letters),
        of_kind[2] / m,
        of_kind[4] / m,
        distinct / m,
        np.minimum(1.0, numbers / m),
        of_kind[8] / m,
        bare.count(_VOWEL) / np.maximum(1, letters),
        np.where(tags > 0, 1 - bare_solid / np.maximum(1, n - spaces), 0),
        np.minimum(1.0, 20 * tags / n),
        ends,
        np.array([min(3, len(_INNER.findall(x))) for x in bare_lines]) / 3,
        np.minimum(1.0, commas / m),
        by_line(lambda x: _MARK.match(x) is not None),
        by_line(lambda x: _SPOKEN.match(x) is not None),
        by_line(lambda x: _FIELD.match(x) is not None),
        by_line(_leads),
        np.minimum(3, gaps) / 3,
        np.minimum(3, whole.count(_TAB)) / 3,
        np.minimum(3, whole.count(_PIPE)) / 3,
        np.minimum(1.0, tight / m),
        whole.is_(_SPACE)[whole.starts],
        of_kind[16] / m,
        np.concatenate([no, same]),
        np.concatenate([same, no]),
        np.concatenate([no, close]),
        np.minimum(longest, 80) / 40,
        np.minimum(w / np.maximum(1, entries), 20) / 10,
        np.where(w > 0, np.minimum(most_blanks, 30), 0) / 10,
        np.minimum(1.0, semicolons / m),
    )
    return np.column_stack(columns).astype(np.float32), np.column_stack([w, letters, of_kind[4], ends]).astype(np.int64)


@dataclass
class Emission:
    """One hidden layer over standardised statistics; gives log P(state | line) - log P(state)."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    log_prior: np.ndarray

    def posterior(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        scores = hidden @ self.w2 + self.b2
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))

    def log_likelihood(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(self.posterior(x), -8.0) - self.log_prior


def _train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 5, hidden: int = 24, epochs: int = 30, decay: float = 1e-4) -> Emission:
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 0.05
    z = ((x - mean) / scale).astype(np.float32)
    params = [
        (rng.standard_normal((x.shape[1], hidden)) / math.sqrt(x.shape[1])).astype(np.float32), np.zeros(hidden, np.float32),
        (rng.standard_normal((hidden, len(FORMS))) / math.sqrt(hidden)).astype(np.float32), np.zeros(len(FORMS), np.float32),
    ]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    target = np.full((len(y), len(FORMS)), 0.02, np.float32)  # some labels are wrong
    target[np.arange(len(y)), y] = 1 - 0.02 * (len(FORMS) - 1)
    step = 0
    batch = 128
    rounds = max(epochs, -(-1500 * batch // max(1, len(y))))
    for epoch in range(min(rounds, 300)):
        order = rng.permutation(len(y))
        rate = 0.01 * (1 - epoch / min(rounds, 300)) + 0.0005
        for lo in range(0, len(y), batch):
            at = order[lo : lo + batch]
            h = np.maximum(z[at] @ params[0] + params[1], 0)
            s = h @ params[2] + params[3]
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            e = (p - target[at]) * (weight[at] / weight[at].sum())[:, None]
            back = (e @ params[2].T) * (h > 0)
            grads = [z[at].T @ back + decay * params[0], back.sum(0), h.T @ e + decay * params[2], e.sum(0)]
            step += 1
            for i, g in enumerate(grads):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.01 * (g * g - second[i])
                params[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    prior = np.bincount(y, weights=weight, minlength=len(FORMS)) + 1
    return Emission(mean, scale, *params, np.log(prior / prior.sum()))


@dataclass
class LineModel:
    """The fitted hidden Markov model."""

    emission: Emission
    log_start: np.ndarray
    log_move: np.ndarray
    common: frozenset[str]

    def states(self, likelihood: np.ndarray, lengths: Sequence[int], allowed: np.ndarray | None = None) -> np.ndarray:
        """The most probable states (Viterbi) of the lines of documents that lie end to end, ``lengths`` lines each; ``allowed`` tells the states each line may have.

        All documents go on together, line by line; the longer ones are left when the shorter have ended.
        """
        lengths = np.asarray(lengths, np.int64)
        if allowed is not None:
            likelihood = np.where(allowed, likelihood, likelihood - 1e9)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        back = np.zeros(likelihood.shape, np.int8)
        score = self.log_start + likelihood[starts]
        last = np.empty((len(lengths), likelihood.shape[1]))
        for i in range(1, int(lengths.max(initial=1))):
            going = int(np.searchsorted(-lengths, -i, side="left"))  # documents of more than i lines
            last[going : len(score)] = score[going:]
            ways = score[:going, :, None] + self.log_move
            best = ways.argmax(1)
            at = starts[:going] + i
            back[at] = best
            score = np.take_along_axis(ways, best[:, None], 1)[:, 0] + likelihood[at]
        last[: len(score)] = score
        path = np.empty(len(likelihood), np.int8)
        state = last.argmax(1)
        for i in range(int(lengths.max(initial=1)) - 1, -1, -1):
            going = int(np.searchsorted(-lengths, -i, side="left"))
            at = starts[:going] + i
            path[at] = state[:going]
            state[:going] = back[at, state[:going]]
        return path


def fit_lines(docs: Sequence[tuple[int, np.ndarray, np.ndarray]], common: frozenset[str], rounds: int = 3, least_move: float = 0.03) -> LineModel:
    """The model from labelled documents, each (form number, statistics of its lines, characters of its lines)."""
    x = np.concatenate([s for _, s, _ in docs])
    chars = np.concatenate([c for _, _, c in docs])
    starts = np.cumsum([0, *(len(s) for _, s, _ in docs)])
    forms = np.array([f for f, _, _ in docs])
    y = np.repeat(forms, np.diff(starts))
    share = np.array([1 / len(s) ** 0.5 for _, s, _ in docs])  # a document of many lines counts for less than their number
    weight = np.repeat(share, np.diff(starts)).astype(np.float32)
    model = None
    for r in range(rounds):
        emission = _train(x, y, weight, seed=5 + r)
        move = np.full((len(FORMS), len(FORMS)), 0.5)
        start = np.full(len(FORMS), 1.0)
        for a, b in zip(starts, starts[1:]):
            np.add.at(move, (y[a : b - 1], y[a + 1 : b]), 1)
            start[y[a]] += 1
        move = np.maximum(move / move.sum(1, keepdims=True), least_move)
        model = LineModel(emission, np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)), common)
        likelihood = emission.log_likelihood(x)
        y = y.copy()
        every = np.arange(len(FORMS))
        form_of_line = np.repeat(forms, np.diff(starts))[:, None]
        paths = model.states(likelihood, np.diff(starts), (every == 0) | (every == form_of_line) | (form_of_line == 0))
        for f, a, b in zip(forms, starts, starts[1:]):
            path = paths[a:b]
            # the label says that much of the document has its form; if the model finds too little of it, the label is kept
            if chars[a:b][path == f].sum() >= 0.3 * chars[a:b].sum():
                y[a:b] = path
    return model


def split_lines(text: str) -> tuple[list[str], np.ndarray]:
    """(non-blank lines, their lengths without outer white space)."""
    lines = [x.rstrip() for x in text.splitlines()]
    lines = [x for x in lines if x.strip()]
    return lines, np.array([len(x.strip()) for x in lines], np.int64)


def form_of(shares: np.ndarray, least: float = 2 / 3) -> str:
    """The form that at least ``least`` of the characters have, prose if none has."""
    i = int(shares[1:].argmax()) + 1
    return FORMS[i] if shares[i] >= least - 1e-9 else FORMS[0]


_LABELLED = pa.schema([("doc", pa.int64()), ("form", pa.int32()), ("line", pa.int32()), ("chars", pa.int64()), ("x", pa.list_(pa.float32()))])


#: Common words that the driver holds, of all languages; more are an error.
MOST_COMMON = 2_000_000


def _language(documents: DataFrame) -> Column:
    """The first part of ``lang`` in lower case; one language for all where there is no such column."""
    return F.coalesce(F.lower(F.trim(F.split("lang", "[-_]")[0])), F.lit("")) if "lang" in documents.columns else F.lit("")


def _document_words(texts: DataFrame, *columns: str) -> DataFrame:
    return texts.select(*columns, F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"), F.lit(0)))).alias("word"))


def common_words(documents: DataFrame, sample: DataFrame, least_share: float = 0.03, over: float = 3.0) -> frozenset[str]:
    """Words in at least ``least_share`` of all documents (language, text) of a language, five at least.

    As a document has only so many words, there are about 1 / ``least_share`` times as many of them at most.

    A word that the labelled ``sample`` (language, form, text) has twice or more in other forms must be ``over`` times as
    frequent in prose there, if the language has labelled prose.
    """
    sizes = documents.where(F.col("text").isNotNull()).groupBy("language").agg(F.count("*").alias("n"))
    counts = _document_words(documents, "language").groupBy("language", "word").agg(F.count("*").alias("d"))
    frequent = counts.join(sizes, "language").where(F.col("d") >= F.greatest(F.lit(5), F.lit(least_share) * F.col("n")))
    prose = lambda p, o: (F.count(F.when(F.col("form") == FORMS[0], 1)).alias(p), F.count(F.when(F.col("form") != FORMS[0], 1)).alias(o))
    forms = _document_words(sample, "language", "form").groupBy("language", "word").agg(*prose("p", "o")).where("o >= 2")
    foreign = forms.join(sample.groupBy("language").agg(*prose("prose", "other")), "language").where((F.col("prose") > 0) & (F.col("p") / F.col("prose") <= over * F.col("o") / F.col("other")))
    kept = frequent.join(foreign, ["language", "word"], "left_anti")
    words = kept.select("word").distinct().limit(MOST_COMMON + 1).collect()
    if len(words) > MOST_COMMON:
        raise ValueError(f"more than {MOST_COMMON} common words")
    return frozenset(r.word for r in words)


def labelled(documents: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(doc, form, text, language) of at most ``most`` labelled documents, chosen by hash; a document's most frequent form, the first by name if equal."""
    votes = labels.where(F.col("form").isin(*FORMS) & F.col("doc_id").isNotNull()).groupBy("doc_id", "form").agg(F.count("*").alias("n"))
    first = votes.withColumn("r", F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("n"), "form"))).where("r = 1").select("doc_id", "form")
    chosen = first.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = documents.select(F.col("doc_id"), F.col("text"), _language(documents).alias("language")).where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy(F.col("doc_id").alias("doc"), "form").agg(F.max("text").alias("text"), F.max("language").alias("language"))  # rows that repeat an id are one


def fit_model(documents: DataFrame, labels: DataFrame, most: int = 6000, most_lines: int = 100) -> LineModel:
    """The line model from a bounded sample: ``most`` labelled documents, of each a run of at most ``most_lines`` lines.

    The common words are counted over all ``documents``, by ``lang`` if they have it.  Statistics are made where the documents are; the driver gets at most most * most_lines rows of them.
    Without any labelled document there is nothing to fit and ValueError is raised.
    """
    from kinograph import session

    sample = session.stage(labelled(documents, labels, most), "labelled")
    common = common_words(documents.select("text", _language(documents).alias("language")), sample)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, characters = _WordKinds(common), _Characters()
        for batch in batches:
            for doc, form, text in zip(*(c.to_pylist() for c in batch.columns)):
                lines, chars = split_lines(text)
                if not lines:
                    continue
                x, _ = line_statistics([lines], kinds, characters)
                at = doc * 2654435761 % max(1, len(lines) - most_lines + 1) if len(lines) > most_lines else 0
                x, chars = x[at : at + most_lines], chars[at : at + most_lines]
                n = len(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * n, pa.int64()), pa.array([FORMS.index(form)] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(chars), pa.array(list(x), pa.list_(pa.float32()))], schema=_LABELLED
                )

    rows = sample.select("doc", "form", "text").mapInArrow(run, "doc bigint, form int, line int, chars bigint, x array<float>").toArrow()
    rows = rows.sort_by([("doc", "ascending"), ("line", "ascending")])
    if not rows.num_rows:
        raise ValueError("no labelled document to fit on")
    doc = rows["doc"].to_numpy()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS))
    cuts = np.flatnonzero(np.diff(doc)) + 1
    form = rows["form"].to_numpy()
    chars = rows["chars"].to_numpy()
    docs = [(int(form[a]), x[a:b], chars[a:b]) for a, b in zip([0, *cuts], [*cuts, len(doc)])]
    return fit_lines(docs, common)


_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("mean_word_length", pa.float64()), ("symbol_ratio", pa.float64()), ("punctuated_lines", pa.float64()),
        ("common_word_share", pa.float64()), ("share_prose", pa.float64()), ("share_list", pa.float64()), ("share_table", pa.float64()), ("share_junk", pa.float64()), ("form", pa.string()),
    ]
)


def _by_size(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` characters of text; a longer text is one slice."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy()
    ends = np.cumsum(sizes)
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def document_quality(documents: DataFrame, model: LineModel) -> DataFrame:
    """Text statistics and the shares of prose, list, table and junk for every row of ``documents`` (doc_id, text).

    n_words, mean_word_length and common_word_share are over the words outside
    of tags; symbol_ratio is the share of characters, white space aside, that
    are in no word; punctuated_lines the share of lines that end a sentence.
    The form shares are of the characters of non-blank lines; ``form`` is the
    form of at least two thirds of them, else prose.

    * null, empty or blank text: n_words 0, ratios, shares and form null;
    * null doc_id and repeated rows: each row has its own result;
    * texts are read whole, whatever their length; lines longer than usual are one line;
    * an empty table gives no row; other columns are not read.
    """

    def scored(texts: list[str | None], kinds: _WordKinds, characters: _Characters) -> list[pa.Array]:
        split = [split_lines(x or "") for x in texts]
        full = np.array([i for i, (lines, _) in enumerate(split) if lines], np.int64)
        docs, chars = [split[i][0] for i in full], [split[i][1] for i in full]
        out = [np.zeros(len(texts), np.int64), *(np.full(len(texts), np.nan) for _ in range(8)), np.full(len(texts), None, object)]
        if len(full):
            x, sums = line_statistics(docs, kinds, characters)
            lengths = np.array([len(d) for d in docs])
            first = np.cumsum(lengths) - lengths
            path = model.states(model.emission.log_likelihood(x), lengths)
            per_doc = lambda v: np.add.reduceat(v, first)
            n, letters, common, ends = per_doc(sums).T
            weight = np.concatenate(chars)
            shares = per_doc(np.where(path[:, None] == np.arange(len(FORMS)), weight[:, None], 0)) / per_doc(weight)[:, None]
            solid = per_doc(np.array([len(x) - sum(map(x.count, set(filter(str.isspace, x)))) for d in docs for x in d]))
            words = np.where(n > 0, n, np.nan)
            for column, value in zip(out, (n, letters / words, (solid - letters) / solid, ends / lengths, common / words, *shares.T, [form_of(s) for s in shares])):
                column[full] = value
        return [pa.array(c, f.type, from_pandas=True) for c, f in zip(out, list(_SCORED)[1:])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, characters = _WordKinds(model.common), _Characters()
        for batch in batches:
            for part in _by_size(batch, 1_000_000):
                yield pa.RecordBatch.from_arrays([part.column(0), *scored(part.column(1).to_pylist(), kinds, characters)], schema=_SCORED)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")).mapInArrow(
        run,
        "doc_id bigint, n_words bigint, mean_word_length double, symbol_ratio double, punctuated_lines double, common_word_share double, "
        "share_prose double, share_list double, share_table double, share_junk double, form string",
    )
