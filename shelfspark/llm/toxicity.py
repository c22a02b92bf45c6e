"""Toxicity: Levenshtein automata over a lexicon trie find misspelt terms, windows of context tell quotation from abuse."""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfspark.llm.common import sampled, stored

# Terms that are looked for besides the learnt ones, words of report and of address, and quotation marks.
SEED_TERMS = [
    "clown", "disgusting", "dumb", "fool", "garbage", "idiot", "imbecile", "jerk", "loser", "moron", "pathetic", "scum", "stupid",
    "trash", "ugly", "vermin", "worthless",
]
REPORT = {
    "said", "says", "called", "quoted", "quote", "wrote", "word", "term", "dit", "appelé", "mot", "sagte", "nannte", "wort", "dijo",
    "llamó", "palabra",
}
ADDRESS = {"you", "your", "you're", "u", "tu", "toi", "vous", "du", "dich", "ihr", "sie", "tú", "usted", "eres"}
WORD = re.compile(r"[^\W_]+")
OPENS, CLOSES = "\"“«‘„", "\"”»’“"

TRAIN_ROWS = 20_000
#: Terms that one automaton carries; more of them are looked for by further ones.
TERMS = 160
SUPPORT = 6
SHARE = 0.5
WINDOW = 6
PIECE = 1 << 21
#: Size of the filter that goes to every task, 4 MB. With far more labelled texts than bits it only stops sparing work.
FILTER_BITS = 1 << 25
FEATURES = ["any", "exact", "fuzzy", "abuse", "abuse_rate", "weight", "quoted", "addressed"]


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


@dataclass
class Automaton:
    """The words within the allowed distance of a term, as one deterministic automaton over character classes."""

    classes: np.ndarray  # class of each code point of the basic plane: 0 no word character, 1 other, 2.. characters of terms
    step: np.ndarray  # state x class -> state; 0 is dead, 1 the start
    term: np.ndarray  # state -> term that ends here at the least distance, or -1
    edits: np.ndarray
    longest: int


def automaton(terms: list[str]) -> Automaton:
    """Intersects the Levenshtein automata of the terms with their trie: a state is a set of (trie node, edits so far)."""
    children: list[dict[str, int]] = [{}]
    ends: list[int] = [-1]
    most: list[int] = [0]  # edits that some term below a node allows
    for t, term in enumerate(terms):
        node, k = 0, allowed_edits(term)
        most[0] = max(most[0], k)
        for c in term:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                ends.append(-1)
                most.append(0)
            node = children[node][c]
            most[node] = max(most[node], k)
        ends[node] = t
    letters = sorted({c for term in terms for c in term})
    number = {c: i + 2 for i, c in enumerate(letters)}

    def closed(items: dict[int, int]) -> frozenset:
        """With what deletions reach; each node with its least edits."""
        todo = list(items.items())
        best = dict(items)
        while todo:
            node, e = todo.pop()
            if e != best[node]:
                continue
            for child in children[node].values():
                if e + 1 <= most[child] and e + 1 < best.get(child, 99):
                    best[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(best.items())

    def moved(state: frozenset, c: str | None) -> frozenset:
        out: dict[int, int] = {}
        for node, e in state:
            for a, child in children[node].items():
                cost = e + (a != c)
                if cost <= most[child] and cost < out.get(child, 99):
                    out[child] = cost
            if e + 1 <= most[node] and e + 1 < out.get(node, 99):
                out[node] = e + 1
        return closed(out)

    first = closed({0: 0})
    index = {frozenset(): 0, first: 1}
    states = [frozenset(), first]
    rows: list[list[int]] = []
    at = 0
    while at < len(states):
        state = states[at]
        wanted = {a for node, _ in state for a in children[node]}
        targets = {c: moved(state, c) for c in wanted}
        other = moved(state, None) if state else frozenset()
        for s in [other, *targets.values()]:
            if s not in index:
                index[s] = len(states)
                states.append(s)
        rows.append([0] + [index[other]] + [index[targets[c]] if c in wanted else index[other] for c in letters])
        at += 1
    term, edits = np.full(len(states), -1, dtype=np.int32), np.zeros(len(states), dtype=np.int32)
    for i, state in enumerate(states):
        found = min(((e, ends[n]) for n, e in state if ends[n] >= 0 and e <= allowed_edits(terms[ends[n]])), default=None)
        if found:
            edits[i], term[i] = found
    classes = np.array([1 if chr(c).isalnum() else 0 for c in range(0x10000)], dtype=np.uint8)
    for c, i in number.items():
        if ord(c) < 0x10000:
            classes[ord(c)] = i
    longest = max((len(t) + allowed_edits(t) for t in terms), default=0)
    return Automaton(classes, np.array(rows, dtype=np.int32).reshape(len(states), -1), term, edits, longest)


@dataclass
class Lexicon:
    terms: list[str]
    weights: np.ndarray
    plain: frozenset = frozenset()  # words near a term that clean texts use: no misspellings
    machines: list[Automaton] = field(default_factory=list)  # of TERMS terms each, in order

    def __post_init__(self):
        if not self.machines:
            self.machines = [automaton(self.terms[at : at + TERMS]) for at in range(0, max(1, len(self.terms)), TERMS)]

    @property
    def longest(self) -> int:
        return max(m.longest for m in self.machines)


def word_spans(text: str, machine: Automaton) -> tuple[np.ndarray, ...]:
    """(class of each character, begins, ends) of the words of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = np.where(points < 0x10000, machine.classes[np.minimum(points, 0xFFFF)], 1).astype(np.uint8)
    inside = np.concatenate([[False], kinds > 0, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return kinds, turns[0::2], turns[1::2]


def find_terms(text: str, machine: Automaton) -> tuple[np.ndarray, ...]:
    """(begins, ends, which words hit, their terms, their edits) over the words of a lower-case text, all words at once."""
    kinds, begins, ends = word_spans(text, machine)
    live = np.flatnonzero(ends - begins <= machine.longest)
    state = np.ones(live.size, dtype=np.int32)
    words, terms, edits = [], [], []
    for t in range(machine.longest + 1):
        over = ends[live] - begins[live] == t
        done, at = live[over], state[over]
        hit = machine.term[at] >= 0
        words.append(done[hit])
        terms.append(machine.term[at[hit]])
        edits.append(machine.edits[at[hit]])
        live, state = live[~over], state[~over]
        if not live.size:
            break
        state = machine.step[state, kinds[begins[live] + t]]
        alive = state > 0
        live, state = live[alive], state[alive]
    which = np.concatenate(words) if words else np.zeros(0, dtype=np.int64)
    order = np.argsort(which, kind="stable")
    gather = lambda x: np.concatenate(x)[order] if x else np.zeros(0, dtype=np.int64)
    return begins, ends, which[order], gather(terms), gather(edits)


def find_all(text: str, machines: list[Automaton]) -> tuple[np.ndarray, ...]:
    """``find_terms`` over the terms of all automata: of a word's terms the nearest, then the first, counts.

    With more than one automaton each reads the distinct words only.
    """
    if len(machines) == 1:
        return find_terms(text, machines[0])
    _, begins, ends = word_spans(text, machines[0])
    number: dict[str, int] = {}
    of = np.array([number.setdefault(text[b:e], len(number)) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)], dtype=np.int64)
    distinct = " ".join(number)
    term, edits = np.full(len(number), -1, dtype=np.int64), np.full(len(number), 99, dtype=np.int64)
    for n, machine in enumerate(machines):
        _, _, which, found, cost = find_terms(distinct, machine)
        better = cost < edits[which]
        edits[which[better]] = cost[better]
        term[which[better]] = found[better] + n * TERMS
    which = np.flatnonzero(term[of] >= 0)
    return begins, ends, which, term[of[which]], edits[of[which]]


def context(text: str, begins: np.ndarray, ends: np.ndarray, w: int) -> tuple[bool, bool]:
    """(quoted, addressed) of word ``w``: marks of quotation on both sides or a word of report, and a word of address nearby."""
    lo, hi = max(0, w - WINDOW), min(len(begins) - 1, w + WINDOW)
    before, after = text[begins[lo] : begins[w]], text[ends[w] : ends[hi]]
    # a mark that opens and closes alike must stand an odd number of times before the word
    marked = any(c in after and (before.count(o) % 2 if o == c else o in before) for o, c in zip(OPENS, CLOSES, strict=True))
    near = {text[begins[i] : ends[i]] for i in range(lo, hi + 1)}
    return marked or not near.isdisjoint(REPORT), not near.isdisjoint(ADDRESS)


def _pieces(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(first, begin, end, last) of the pieces of a text: cut at blanks, with the words around that their context needs."""
    at = 0
    while at < len(text):
        to = len(text) if len(text) - at <= PIECE else text.rfind(" ", at, at + PIECE) + 1 or at + PIECE
        first, last = at, to
        for _ in range(2 * WINDOW):  # blanks may stand in a row
            blank = text.rfind(" ", max(0, first - PIECE), max(0, first - 1))
            first = blank if blank >= 0 else 0 if first <= PIECE else first
            blank = text.find(" ", last + 1, last + PIECE)
            last = blank if blank >= 0 else len(text) if len(text) - last <= PIECE else last
        yield first, at, to, last
        at = max(to, at + 1)


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The features of a whole text; very long ones are read in pieces, each with the words around it for context."""
    text = (text or "").lower()
    words = exact = fuzzy = quoted = addressed = 0
    abuse = weight = 0.0
    for first, at, to, last in _pieces(text):
        part = text[first:last] if first or last < len(text) else text
        begins, ends, which, terms, edits = find_all(part, lexicon.machines)
        own = (begins + first >= at) & (begins + first < to)
        words += int(own.sum())
        for w, t, e in zip(which.tolist(), terms.tolist(), edits.tolist(), strict=True):
            if not own[w] or (e and part[begins[w] : ends[w]] in lexicon.plain):
                continue
            said, you = context(part, begins, ends, w)
            exact, fuzzy, quoted, addressed = exact + (not e), fuzzy + bool(e), quoted + said, addressed + you
            value = float(lexicon.weights[t]) * (0.5**e)
            abuse += value * (0.4 if said else 1.0) * (1.3 if you else 1.0)
            weight = max(weight, value)
    hits = exact + fuzzy
    return [
        float(hits > 0), np.log1p(exact), np.log1p(fuzzy), np.log1p(abuse), min(1.0, 100.0 * hits / max(100, words)), weight,
        quoted / hits if hits else 0.0, addressed / hits if hits else 0.0,
    ]


def _places(key: Column) -> list[Column]:
    """The two bits of an id in the filter, from its hash."""
    return [key.bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(FILTER_BITS - 1))]


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the ids (``doc_id``) in ``FILTER_BITS`` bits, set bits only moved: a fixed size at any number of ids."""
    bit = ids.select(F.explode(F.array(*_places(F.xxhash64("doc_id")))).alias("p"))
    words = bit.groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("b"))
    found = words.toPandas()  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    out[found["w"].to_numpy()] = found["b"].to_numpy()
    return out


def _may_hold(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes of ids the filter may hold: all that it was made of and, when it is full, others."""
    out = np.ones(len(hashes), dtype=bool)
    for p in (hashes & (FILTER_BITS - 1), (hashes.view(np.uint64) >> np.uint64(32)).view(np.int64) & (FILTER_BITS - 1)):
        out &= (held[p >> 6] >> (p & 63) & 1).astype(bool)
    return out


def _vocabularies(with_words: bool, held: np.ndarray | None = None):
    """(id, kind and, if asked for, distinct words) of each text; the kind is its two least hashes of three neighbouring words.

    With a filter, texts whose ids it cannot hold are passed over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if held is not None:
                batch = batch.filter(pa.array(_may_hold(held, batch.column(2).to_numpy())))
            at, kinds, words = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                found = WORD.findall((text or "").lower())
                if found:
                    raw = [w.encode() for w in found]
                    ring = raw + (raw * 2)[:2]
                    runs = {zlib.crc32(c, zlib.crc32(b, zlib.crc32(a))) for a, b, c in zip(ring, ring[1:], ring[2:])}
                    first, second = (heapq.nsmallest(2, runs) * 2)[:2]
                    at.append(row)
                    kinds.append(first << 31 ^ second)
                    words.append(sorted(set(found)) if with_words else None)
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(kinds, pa.int64()), pa.array(words, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "kind", "words"])

    return run


def learn_lexicon(texts: DataFrame, known: DataFrame, *, support: int = SUPPORT, share: float = SHARE) -> Lexicon:
    """Terms from rows of (``doc_id``, ``text``) and (``doc_id``, ``label``): words whose share of toxic texts is surely above ``share``.

    Near copies of a text would make all its words look like terms, so of the texts of one kind (equal two least hashes of
    three words, as close copies mostly have and other texts do not for a common passage) one counts. All words that pass
    the tests reach the driver, and the words of clean texts that lie near a term.
    """
    # texts stay where they lie: ids and kinds choose the rows that count, then their distinct words move once; a filter of
    # the chosen ids, which has one size whatever their number, keeps most others from moving, and the join the rest
    schema = T.StructType([
        T.StructField("doc_id", texts.schema["doc_id"].dataType), T.StructField("kind", T.LongType()), T.StructField("words", T.ArrayType(T.StringType()))
    ])
    texts = texts.select("doc_id", "text")
    kinds = texts.mapInArrow(_vocabularies(False), schema).select("doc_id", "kind")
    one = kinds.join(known.hint("merge"), "doc_id").groupBy("kind").agg(F.max(F.struct("label", "doc_id")).alias("d")).select("kind", "d.*")
    one = stored(one, "kinds")
    hashed = texts.withColumn("hash", F.xxhash64("doc_id"))
    docs = hashed.mapInArrow(_vocabularies(True, id_filter(one)), schema).join(one.hint("merge"), ["doc_id", "kind"])
    docs = docs.dropDuplicates(["doc_id", "kind"])
    counts = docs.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.sum("label").alias("bad"), F.count("*").alias("n"))
    p, z2 = F.col("bad") / F.col("n"), 1.96**2
    lower = (p + z2 / (2 * F.col("n")) - 1.96 * F.sqrt((p * (1 - p) + z2 / (4 * F.col("n"))) / F.col("n"))) / (1 + z2 / F.col("n"))
    odds = F.log((F.col("bad") + 0.5) / (F.col("n") - F.col("bad") + 0.5))
    counts = stored(counts.withColumns({"lower": lower, "odds": odds}), "words")
    best = counts.filter((F.col("bad") >= support) & (F.col("lower") > share) & (F.length("word") >= 3))
    found = {r.word: r.odds for r in best.collect()}
    weights = {t: 2.0 for t in SEED_TERMS} | found
    names = sorted(weights)
    lexicon = Lexicon(names, np.array([weights[t] for t in names]))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for word in batch.column(0).to_pylist():
                _, _, which, _, edits = find_all(word, lexicon.machines)
                if which.size == 1 and edits[0]:
                    kept.append(word)
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string())], names=["word"])

    # bounded by the number of words within the allowed distance of a term
    clean = counts.filter((F.col("n") - F.col("bad") >= 2) & (F.col("odds") < 0) & (F.length("word") <= lexicon.longest))
    lexicon.plain = frozenset(r.word for r in clean.select("word").mapInArrow(near, "word string").collect())
    return lexicon


def document_features(docs: DataFrame, lexicon: Lexicon, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t, lexicon) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=schema.fieldNames())

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights and, last, the constant of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve(x.T * (p * (1 - p)) @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``score``, from labels (id, label 0/1) of which the caller chose the rows.

    The lexicon is learnt from all labelled documents, the weights of the eight features from at most about ``train_rows``
    of them; every whole text is scored. Null text counts as empty; a text without a hit gets the score of such texts. Without labels the
    seed terms decide, each hit by its weight. Repeated rows give repeated rows, an empty table none; other columns are
    ignored.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("label IS NOT NULL")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lexicon = learn_lexicon(texts, known)
    x = stored(document_features(texts, lexicon), "features")
    train = x.join(stored(sampled(known, "doc_id", train_rows), "labels"), "doc_id").select("x", "label").toPandas()
    if train["label"].nunique() == 2:
        w = logistic(np.array(train["x"].tolist()), train["label"].to_numpy(dtype=float))
    else:
        w = np.array([0.0, 0, 0, 2.0, 0, 1.0, -1.0, 0.5, -3.0])
    z = F.lit(float(w[-1]))
    for i in range(len(FEATURES)):
        z = z + F.element_at("x", i + 1) * float(w[i])
    return x.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))
