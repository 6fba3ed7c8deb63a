"""Toxicity: Levenshtein automata meet a lexicon trie, context windows tell quotation from abuse.

1. The lexicon is learned from the labelled documents. Candidates are whole
   words and word beginnings (stems, to which any ending may be added); an
   entry is one that is far more frequent outside quotations, by documents, among toxic ones. Of
   a chain of beginnings the most specific that loses no toxic documents is
   kept. Of documents that share one of ``SKETCHES`` MinHash values only one
   counts, so that the plain words of a text with many copies are no entries. An entry's weight is the share of toxic ones among its documents.
2. Entries form a trie. For each word of a text the Levenshtein automaton of
   the word (all strings within some edits of it, as a bit-parallel machine)
   is run along the trie, so that shared beginnings are matched once and dead
   branches cut off. Whole words of 4 to 7 characters may differ by one edit,
   longer ones by two, stems from 7 characters on by one. By the pigeonhole
   principle such a word shares a piece of the entry, in place; words that
   share none are passed over in numpy, which loses nothing.
3. A window of ``WINDOW`` words around each hit tells whether it is quoted,
   reported on, or plain. How far hits of each context, and of each number of
   edits, are to be believed is learned: the share of toxic ones among the
   documents that hold no other hits, from a prior on. Words that clean
   documents hold as they are are no misspellings.
4. A document's score is a logistic regression, trained by
   follow-the-regularised-leader, on the sum of its hits' beliefs, plain and
   by length of the text.

Words are runs of letters and digits, folded to lower case, and what lies
between two white spaces where other marks are inside it (``st*pid``).
Null and empty texts have no hits and get the score of the intercept. A
document with several labels counts as their mean, rounded half up. Without
labels the score is a half; with labels of one kind only, and in empty tables,
there is no lexicon and the score is the intercept's.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from callmeter.llm.linear import fit, hash_share, id_remainder, probabilities
from callmeter.llm.text import NOT_SPACE, WORD, Hasher, Slice, find_words, lower, mix, n_grams, runs, seeds, slices
from callmeter.operators.durable import cut_lineage

# At most about this many labelled documents are learned from.
SAMPLE = 16_000
SHARDS = 8
# Lengths of stems, in characters, and the longest word that is an entry.
STEM = (3, 12)
# An entry is this many times as frequent among toxic documents, and in at least so many of them.
LIFT = 5.0
SUPPORT = 5
# The log likelihood ratio of its documents is beyond chance, though very many candidates are tried.
EVIDENCE = 15.0
WINDOW = 8
THRESHOLD = 0.3
PLAIN, REPORTED, QUOTED = range(3)
# What hits are believed before anything is learned: by edits, by context, and for how many documents that counts.
EDIT_PRIOR = (1.0, 0.9, 0.8)
CONTEXT_PRIOR = (1.0, 0.7, 0.2)
PRIOR_DOCUMENTS = 8.0
# MinHash values over word pairs by which copies are told, in the sample.
SKETCHES = 4
_REMEMBERED = 1 << 18
_U = np.uint64

# Words of reporting, and marks of quotation.
REPORTING = frozenset(
    "said says saying say called calls calling quote quotes quoted quoting wrote writes word words term insult insults "
    "sagte sagt nannte nennt zitat zitiert schrieb wort begriff dit disait appelle cite citation mot terme "
    "dijo dice llama cita palabra insulto".split()
)
_OPENING, _CLOSING = "“„«‘‹", "”“»’›"
_WORDS = re.compile(r"[^\W_]+")
_QUOTATION = re.compile(r'"[^"\n]*"|“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»|^\s*>.*$', re.M)


def edits(characters: int, stem: bool) -> int:
    """How many edits an entry of so many characters allows."""
    if stem:
        return 1 if characters >= 7 else 0
    return 0 if characters < 4 else 1 if characters < 8 else 2


class Automaton:
    """The strings within ``most`` edits of a word: state ``d`` holds, bit by bit, the beginnings of the word that ``d`` edits reach."""

    def __init__(self, word: str, most: int):
        self._masks: dict[str, int] = {}
        for i, c in enumerate(word):
            self._masks[c] = self._masks.get(c, 0) | 2 << i
        self._all = (2 << len(word)) - 1
        self.accept = 1 << len(word)
        self.start = tuple((2 << d) - 1 & self._all for d in range(most + 1))

    def step(self, state: tuple[int, ...], character: str) -> tuple[int, ...]:
        mask = self._masks.get(character, 0)
        reached = (state[0] << 1) & mask
        out = [reached]
        for d in range(1, len(state)):
            # A match; a character more, another or one less than in the word.
            reached = ((state[d] << 1) & mask | state[d - 1] | state[d - 1] << 1 | reached << 1) & self._all
            out.append(reached)
        return tuple(out)


class Trie:
    """The entries of a lexicon. Nodes are (children, whole word's entry, stem's entry)."""

    def __init__(self, entries: list[tuple[str, bool]]):
        self.entries = entries
        self.root: list = [{}, None, None]
        for number, (text, stem) in enumerate(entries):
            node = self.root
            for c in text:
                node = node[0].setdefault(c, [{}, None, None])
            node[2 if stem else 1] = number
        self._lengths = [(len(t), s, edits(len(t), s)) for t, s in entries]
        self._most: dict[int, int] = {}

    def _edits_of(self, length: int) -> int:
        """The most edits at which a word of so many characters may match an entry; -1 if none may."""
        if length not in self._most:
            near = [k for n, stem, k in self._lengths if n - k <= length and (stem or length <= n + k)]
            self._most[length] = max(near, default=-1)
        return self._most[length]

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, entry) of the closest entry, the earliest of equally close ones; None if none is close enough."""
        most = self._edits_of(len(word))
        if most < 0:
            return None
        automaton = Automaton(word, most)
        best = None
        open_ = [(self.root, automaton.start)]
        while open_:
            (children, whole, stem), state = open_.pop()
            for entry, accept in ((whole, automaton.accept), (stem, -1)):
                if entry is None:
                    continue
                own = edits(len(self.entries[entry][0]), entry == stem and self.entries[entry][1])
                found = next((d for d in range(min(own, len(state) - 1) + 1) if state[d] & accept), None)
                if found is not None and (best is None or (found, entry) < best):
                    best = (found, entry)
            for c, child in children.items():
                after = automaton.step(state, c)
                # The last state holds what the others do.
                if after[-1]:
                    open_.append((child, after))
        return best


@dataclass
class Pieces:
    """Pieces of entries that a word has to share, by place: hashes by (from, anchored at the end, length)."""

    hashes: dict[tuple[int, bool, int], set[bytes]] = field(default_factory=dict)
    shortest: dict[tuple[int, bool, int], int] = field(default_factory=dict)
    longest: dict[tuple[int, bool, int], int] = field(default_factory=dict)

    def add(self, text: str, stem: bool) -> None:
        n, k = len(text), edits(len(text), stem)
        cuts = [round(i * n / (k + 1)) for i in range(k + 2)]
        size = len(text.encode())
        for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            piece = text[low:high].encode()
            if i == 0:
                places = [(0, False)]
            elif i == k and not stem:
                places = [(len(piece), True)]
            else:
                # Each edit before it moves a piece by one character, of up to four bytes.
                at = len(text[:low].encode())
                places = [(max(0, at + shift), False) for shift in range(-4 * k, 4 * k + 1) if at + shift >= 0]
            for place, at_end in places:
                key = (place, at_end, len(piece))
                self.hashes.setdefault(key, set()).add(piece)
                self.shortest[key] = min(self.shortest.get(key, 1 << 30), size - 4 * k)
                self.longest[key] = max(self.longest.get(key, 0), 1 << 30 if stem else size + 4 * k)


class Matcher:
    """Finds the hits of a lexicon in slices. One per task."""

    def __init__(self, entries: list[tuple[str, bool]], known: frozenset[str] = frozenset()):
        self.trie, self._known = Trie(entries), known
        pieces = Pieces()
        for text, stem in entries:
            pieces.add(text, stem)
        self._hasher = Hasher()
        self._tests = []
        for key, texts in pieces.hashes.items():
            codes = [self._hash(t) for t in texts]
            self._tests.append((*key, pieces.shortest[key], pieces.longest[key], np.sort(np.array(codes, dtype=_U))))
        self._matched: dict[int, tuple[int, int] | None] = {}

    def _hash(self, piece: bytes) -> int:
        sums = self._hasher.prefix(np.frombuffer(piece, np.uint8))
        return int(self._hasher.span(sums, np.array([0]), np.array([len(piece)]))[0])

    def _possible(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words that share a piece with an entry."""
        out = np.zeros(len(starts), bool)
        size = ends - starts
        for place, at_end, length, shortest, longest, codes in self._tests:
            at = np.flatnonzero(~out & (size >= max(shortest, place if at_end else place + length)) & (size <= longest))
            begin = ends[at] - place if at_end else starts[at] + place
            hashes = self._hasher.span(sums, begin, begin + length)
            near = np.minimum(np.searchsorted(codes, hashes), len(codes) - 1)
            out[at] = codes[near] == hashes
        return np.flatnonzero(out)

    def hits(self, s: Slice) -> tuple[list[list[tuple[int, int, int, str]]], np.ndarray]:
        """For each row its hits (entry, edits, context, word) in order, and its number of words."""
        data = _marks_plain(lower(s.data))
        starts, ends = runs(data, s.offsets, WORD)
        words = np.diff(np.searchsorted(starts, s.offsets))
        out: list[list] = [[] for _ in words]
        if len(starts) == 0 or not self._tests:
            return out, words
        # Stretches without white space that hold several words, from the first to the last.
        low, high = runs(data, s.offsets, NOT_SPACE)
        first, last = np.searchsorted(starts, low), np.searchsorted(starts, high) - 1
        joined = last > first
        starts = np.concatenate([starts, starts[first[joined]]])
        ends = np.concatenate([ends, ends[last[joined]]])
        sums = self._hasher.prefix(data)
        at = self._possible(sums, starts, ends)
        keys = self._hasher.span(sums, starts[at], ends[at])
        raw = s.data.tobytes()
        folded = data.tobytes()
        if len(self._matched) > _REMEMBERED:
            self._matched.clear()
        found = []
        for k, key in zip(at.tolist(), keys.tolist(), strict=True):
            if key not in self._matched:
                word = folded[starts[k] : ends[k]].decode("utf-8", "replace")
                match = self.trie.match(word)
                self._matched[key] = None if match is None or match[0] and word in self._known else match
            if self._matched[key] is not None:
                found.append((int(starts[k]), int(ends[k]), *self._matched[key]))
        row = np.searchsorted(s.offsets, [f[0] for f in found], "right") - 1
        closed = -1
        for (start, end, distance, entry), own in sorted(zip(found, row.tolist(), strict=True), key=lambda f: (f[0][0], f[0][2], f[0][1])):
            if start < closed:
                continue
            closed = end
            context = _context(raw, start, end, int(s.offsets[own]), int(s.offsets[own + 1]))
            out[own].append((entry, distance, context, folded[start:end].decode("utf-8", "replace")))
        return out, words


def _marks_plain(data: np.ndarray) -> np.ndarray:
    """The text with the marks of Latin-1 and of general punctuation as ASCII marks, byte for byte; ``data`` is changed."""
    if len(data) > 2:
        latin = np.flatnonzero(data == 0xC2)
        general = np.flatnonzero((data[:-1] == 0xE2) & ((data[1:] & 0xFE) == 0x80))
        for at, size in ((latin, 2), (general, 3)):
            for k in range(size):
                data[at + k] = 0x21
    return data


def _context(raw: bytes, start: int, end: int, low: int, high: int) -> int:
    """What the words around a hit make of it."""
    # Words of up to 32 bytes on average, so that whole texts are not decoded at each hit.
    before = raw[max(low, start - 32 * WINDOW) : start].decode("utf-8", "ignore")
    after = raw[end : min(high, end + 32 * WINDOW)].decode("utf-8", "ignore")
    near = [m.span() for m in _WORDS.finditer(before)]
    before = before[near[-WINDOW][0] if len(near) >= WINDOW else 0 :]
    far = [m.span() for m in _WORDS.finditer(after)]
    after = after[: far[WINDOW - 1][1] if len(far) >= WINDOW else len(after)]
    line = before.rpartition("\n")[2]
    if _is_quoted(line, after.partition("\n")[0]):
        return QUOTED
    around = set(_WORDS.findall(before.lower())) | set(_WORDS.findall(after.lower()))
    return PLAIN if REPORTING.isdisjoint(around) else REPORTED


def _is_quoted(before: str, after: str) -> bool:
    if before.lstrip().startswith(">"):
        return True
    if before.count('"') % 2 and '"' in after:
        return True
    # A plain apostrophe opens after a blank and closes before none of a word's characters.
    if re.search(r"(?:^|\s)'[^']*$", before) and re.search(r"'(?!\w)", after):
        return True
    opened = max(before.rfind(c) for c in _OPENING)
    return opened > max(before.rfind(c, opened + 1) for c in _CLOSING) and any(c in after for c in _CLOSING)


@dataclass
class Model:
    """A learned lexicon and what its hits are worth; ``weights`` as ``linear.fit`` gives them."""

    entries: list[tuple[str, bool]]
    worth: list[float]
    known: frozenset[str]
    by_edits: tuple[float, ...]
    by_context: tuple[float, ...]
    weights: np.ndarray

    def evidence(self, hits: list) -> float:
        return sum(
            self.worth[h[0]] * self.by_edits[h[1]] * self.by_context[h[2]] for h in hits if not (h[1] and h[3] in self.known)
        )


def _features(evidence: float, words: int) -> np.ndarray:
    return np.array([min(1.0, evidence), np.log1p(evidence), np.log1p(100 * evidence / max(1, words))])


def _beginnings(text: str) -> set[tuple[str, bool]]:
    """The whole words of a text, as far as it is not quoted, and their beginnings."""
    out = set()
    for word in set(_WORDS.findall(_QUOTATION.sub(" ", text))):
        if len(word) >= STEM[0]:
            out.update((word[:k], True) for k in range(STEM[0], min(len(word), STEM[1]) + 1))
            if len(word) <= 2 * STEM[1]:
                out.add((word, False))
    return out


def _document_counts(rows: DataFrame, wanted: set | None) -> DataFrame:
    """How many of the documents hold each word or beginning: rows (entry, stem, n)."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for s in slices(batches):
            raw = lower(s.data).tobytes()
            for a, b in zip(s.offsets[:-1], s.offsets[1:], strict=True):
                own = _beginnings(raw[a:b].decode("utf-8", "replace"))
                counts.update(own if shared.value is None else own & shared.value)
            if len(counts) > 1 << 19:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    found = rows.select("text").mapInArrow(run, "entry string, stem boolean, n long")
    return found.groupBy("entry", "stem").agg(F.sum("n").alias("n"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([e for e, _ in counts], pa.string()), pa.array([s for _, s in counts], pa.bool_()), pa.array(list(counts.values()), pa.int64())],
        names=["entry", "stem", "n"],
    )


def choose_entries(toxic: dict, clean: dict, toxic_docs: int, clean_docs: int) -> dict[tuple[str, bool], float]:
    """The entries and their worth, from the number of toxic and clean documents that hold each candidate."""

    def is_telling(key, n: int) -> bool:
        if n < SUPPORT:
            return False
        expected = max(1, toxic_docs) * (clean.get(key, 0) + 1) / (clean_docs + 1)
        return n >= LIFT * expected and n * np.log(n / expected) - (n - expected) >= EVIDENCE

    good = {key for key, n in toxic.items() if is_telling(key, n)}
    kept = set()
    # What continues a beginning: the whole word of that text, and beginnings of one character more.
    further: dict[str, int] = {}
    for text, stem in good:
        before = text[:-1] if stem else text
        if (before, True) in good or not stem:
            further[before] = max(further.get(before, 0), toxic[text, stem])
    for text, stem in good:
        if not stem or further.get(text, 0) < 0.9 * toxic[text, True]:
            kept.add((text, stem))
    worth = {key: toxic[key] / (toxic[key] + clean.get(key, 0)) for key in kept}

    def is_covered(text: str, stem: bool) -> bool:
        shorter = ((text[:k], True) for k in range(STEM[0], len(text) + (not stem)))
        return any(key in kept and worth[key] >= 0.9 * worth[text, stem] for key in shorter)

    # A beginning that tells nothing beyond its best continuation is none of its own.
    for text, stem in sorted(kept):
        further = [toxic[key] for key in kept if key != (text, stem) and key[0].startswith(text) and worth[key] > worth[text, stem]]
        if stem and further and not is_telling((text, True), toxic[text, True] - max(further)):
            kept.discard((text, True))
    # Of several entries that match a word the first counts, that of greatest worth.
    out = sorted((key for key in kept if not is_covered(*key)), key=lambda key: (-worth[key], key))
    return {key: worth[key] for key in out}


def _without_copies(rows: DataFrame) -> DataFrame:
    """The rows of the sample, one of those that share a MinHash value, that of least id, value by value."""
    names = [f"sketch{k}" for k in range(SKETCHES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, odd = Hasher(), seeds(SKETCHES, salt=12)
        for s in slices(batches):
            grams, first = n_grams(find_words(s, hasher), 2)
            least = []
            for k in range(SKETCHES):
                own = mix(grams * odd[k] + _U(k))
                filled = np.flatnonzero(np.diff(first))
                out = np.zeros(len(first) - 1, _U)
                if len(filled):
                    out[filled] = np.minimum.reduceat(own, first[filled])
                least.append(pa.array(out.view(np.int64)))
            yield pa.RecordBatch.from_arrays([s.rows.column(0), *least], names=["doc_id", *names])

    schema = StructType([rows.schema["doc_id"], *(StructField(n, LongType()) for n in names)])
    kept = rows.select("doc_id", "text").mapInArrow(run, schema)
    for name in names:
        kept = kept.groupBy(name).agg(F.min_by(F.struct(*kept.columns), "doc_id").alias("own")).select("own.*")
    return rows.join(kept.select("doc_id"), "doc_id", "left_semi")


_HITS = "hits array<struct<entry:int,distance:int,context:int,word:string>>, words long"


def _with_hits(rows: DataFrame, entries: list[tuple[str, bool]]) -> DataFrame:
    """The sample's labels and shards with the hits of each text."""
    fields = "label int, shard long, " + _HITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(entries)
        kind = pa.list_(pa.struct([("entry", pa.int32()), ("distance", pa.int32()), ("context", pa.int32()), ("word", pa.string())]))
        for s in slices(batches):
            hits, words = matcher.hits(s)
            own = [[dict(zip(("entry", "distance", "context", "word"), h, strict=True)) for h in row] for row in hits]
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(1), s.rows.column(2), pa.array(own, kind), pa.array(words)], names=["label", "shard", "hits", "words"]
            )

    return cut_lineage(rows.select("text", "label", "shard").mapInArrow(run, fields))


def _beliefs(found: DataFrame) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """How far hits are believed by edits and by context, from the documents whose hits are all alike in that."""
    near, far = F.array_min(F.col("hits.distance")), F.array_max(F.col("hits.distance"))
    plain, quoted = F.array_min(F.col("hits.context")), F.array_max(F.col("hits.context"))
    groups = found.filter(F.size("hits") > 0).groupBy("label", near.alias("near"), far.alias("far"), plain.alias("least"), quoted.alias("most"))
    rows = groups.agg(F.count(F.lit(1)).alias("n")).collect()

    def belief(prior: float, low: str, high: str, value: int) -> float:
        n = [sum(r["n"] for r in rows if r["label"] == label and r[low] == r[high] == value) for label in (0, 1)]
        return (prior * PRIOR_DOCUMENTS + n[1]) / (PRIOR_DOCUMENTS + n[0] + n[1])

    return (
        tuple(belief(p, "near", "far", d) if d else 1.0 for d, p in enumerate(EDIT_PRIOR)),
        tuple(belief(p, "least", "most", c) if c else 1.0 for c, p in enumerate(CONTEXT_PRIOR)),
    )


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, label: str = "toxic", sample: int = SAMPLE
) -> Model:
    """A model learned from the labelled ``docs`` that meet ``learn_from``, a bounded sample of them.

    ``sample`` bounds the expected number of documents learned from; which
    ones is decided by a hash of their id. Lexicon, exceptions and beliefs
    come from the sample and are thereby bounded too.
    """
    marked = labels.select("doc_id", F.col(label).alias("label")).dropna()
    marked = marked.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    if learn_from is not None:
        marked = marked.filter(learn_from)
    chosen = hash_share("doc_id", sample, marked.count())
    rows = docs.select("doc_id", "text").filter(chosen & F.col("text").isNotNull()).join(marked.filter(chosen), "doc_id")
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).alias("shard")
    rows = cut_lineage(_without_copies(rows.dropDuplicates(["doc_id"])).select("text", "label", shard))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    counted = _document_counts(rows.filter("label = 1"), None).filter(F.col("n") >= SUPPORT).collect()
    toxic = {(r["entry"], r["stem"]): r["n"] for r in counted}
    counted = _document_counts(rows.filter("label = 0"), set(toxic)).collect() if toxic else []
    clean = {(r["entry"], r["stem"]): r["n"] for r in counted}
    chosen_entries = choose_entries(toxic, clean, sizes.get(1, 0), sizes.get(0, 0)) if sizes.get(0) else {}
    entries = list(chosen_entries)
    found = _with_hits(rows, entries)
    hits = found.select("label", F.explode("hits").alias("hit")).filter("hit.distance > 0")
    words = hits.groupBy("hit.word").agg(F.sum(F.lit(1) - F.col("label")).alias("clean"), F.sum("label").alias("toxic"))
    known = frozenset(r["word"] for r in words.filter("clean > toxic").collect())
    found = found.withColumn("hits", F.filter("hits", lambda h: (h["distance"] == 0) | ~h["word"].isin(list(known)))) if known else found
    by_edits, by_context = _beliefs(found)
    model = Model(entries, list(chosen_entries.values()), known, by_edits, by_context, np.zeros((4, 1), np.float32))

    def examples(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        ids = np.arange(3)
        for hits, words, label in pdf.sample(frac=1.0, random_state=1)[["hits", "words", "label"]].itertuples(index=False):
            own = [(h["entry"], h["distance"], h["context"], h["word"]) for h in hits]
            yield ids, _features(model.evidence(own), int(words)), int(label)

    model.weights = fit(found, examples, 3, 1, SHARDS, l1=0.0, epochs=6)
    return model


def score_toxicity(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The columns ``keep`` and the chance that a text is toxic. Null texts count as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        matcher = Matcher(m.entries, m.known)
        for s in slices(batches, "__text"):
            hits, words = matcher.hits(s)
            x = np.array([_features(m.evidence(h), int(n)) for h, n in zip(hits, words, strict=True)])
            score = probabilities(x @ m.weights[:3].astype(float) + m.weights[3])[:, 0]
            yield pa.RecordBatch.from_arrays([*s.rows.columns[: len(keep)], pa.array(score)], names=[*keep, name])

    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = StructType([*rows.schema.fields[:-1], StructField(name, DoubleType())])
    return rows.mapInArrow(run, schema)


def learnable() -> Column:
    return id_remainder("doc_id", 4) != 2


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted, by a model that held-out documents had no part in."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels, learnable()))
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
