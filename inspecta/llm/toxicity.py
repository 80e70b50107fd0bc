"""Toxicity scores from a learned lexicon, misspelling automata and context.

1. *Lexicon*: words that are much more frequent, by smoothed log-odds over
   documents, in texts labelled toxic than in others.  Learned from a bounded
   sample of labelled rows (``fit_rows`` per label, chosen by a hash of doc_id,
   equal texts once).  Texts in which a word stands between the same two words
   count once for it, so that near copies of a text neither make nor unmake a term.
2. *Misspellings*: a word that isn't a term is looked up by running its Levenshtein
   automaton over the trie of the lexicon: both advance together, and a branch of
   the trie is left as soon as the automaton can't accept any more.  Every term of
   two or more characters matches within one edit.  Misspellings of terms shorter
   than ``FUZZY_LENGTH`` and ``SHORT_LENGTH`` add up apart, as chance hits are more
   common there; a word near such a term that clean texts use is not a misspelling.
   (A term of one character has no misspellings: any character is one edit from it.)
3. *Context*: the words around each hit tell abuse (another hit, a form of address)
   from quotation (inside quotation marks, reporting words); hits add up apart.
4. *Weights* of these sums: a logistic regression (Spark ML) on the labelled rows
   that the lexicon didn't use.  Rows with terms take part once more with their
   terms misspelled, so that misspellings get a weight where labelled texts hold none.

Labels are used only where crc32(doc_id) mod 5 isn't 0: remainders 1 to 3 for the
lexicon, 4 for the weights (all of 1 to 4, if 4 lacks one of the labels).  A score depends on the text alone.

Defined cases: null text equals empty text; an empty text has no hits and gets the
score of any text without hits.  Without labels of both kinds the score is 0.
Labels of a null doc_id, null labels and labels of absent documents don't count;
a doc_id labelled twice counts as toxic if one label is.  Rows that repeat score
alike.  Very long texts are read whole.  An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inspecta.llm.base import first_by_hash, give_back, id_text, map_rows, stored

FIT_ROWS = 12_000       # labelled rows of each label that are learned from, at most
MIN_DOCS = 3            # toxic texts a term occurs in, between different words
MIN_ODDS = 3.0          # smoothed log-odds of a term
FUZZY_LENGTH = 6        # misspellings of shorter terms have a sum of their own
SHORT_LENGTH = 4        # and those of still shorter ones another
AROUND = 8              # words of context on each side
ROWS = 1000             # rows whose texts are Python strings at once
WORD = re.compile(r"[^\W_]+")
# fixed word lists of the context scores
REPORTING = frozenset("""said says say saying wrote writes quote quoted quotes called calls word words term insult
reported reports according claimed sagte sagt schrieb zitat wort genannt dit écrit cité mot appelé dijo dice escribió
cita palabra llamado""".split())
ADDRESS = frozenset("you your youre u du dich dir dein deine tu te toi ton vous votre usted tú eres ustedes".split())
QUOTES = re.compile("[\"“”„«»‹›]")


class LevenshteinAutomaton:
    """Accepts the words within one edit of ``word``.

    A state is the set of places in ``word`` that are reached without an edit and
    with one, as two bit masks; a step moves all places at once."""

    def __init__(self, word: str):
        self.end = 1 << len(word)
        self.all = (self.end << 1) - 1
        self.moves: dict[str, int] = {}
        for i, ch in enumerate(word):
            self.moves[ch] = self.moves.get(ch, 0) | 2 << i

    def start(self) -> tuple[int, int]:
        return 1, 3 & self.all

    def step(self, state: tuple[int, int], ch: str) -> tuple[int, int]:
        exact, edited = state
        moves = self.moves.get(ch, 0)
        same = exact << 1 & moves
        # a move, a character too many, another character, a character too few
        return same, (edited << 1 & moves | exact | exact << 1 | same << 1) & self.all

    def accepts(self, state: tuple[int, int]) -> bool:
        return bool((state[0] | state[1]) & self.end)

    def alive(self, state: tuple[int, int]) -> bool:
        return bool(state[0] | state[1])


def _trie(words: list[tuple[str, float]]) -> dict:
    root: dict = {}
    for word, strength in words:
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = max(strength, node.get("", 0.0))
    return root


class Halves:
    """Tries of the halves of terms that have ``least`` or more characters.

    One edit leaves the first or the second half of a term as it is.  So the trie
    of the terms is entered behind the first half, or, read backwards, before the
    second, and the automaton runs on the rest of the word only."""

    def __init__(self, terms: dict[str, float], least: int):
        after: dict[str, list] = {}
        before: dict[str, list] = {}
        for t, s in terms.items():
            half = len(t) // 2
            after.setdefault(t[:half], []).append((t[half:], s))
            before.setdefault(t[half:], []).append((t[:half][::-1], s))
        self.after, self.before = ({k: _trie(v) for k, v in side.items()} for side in (after, before))
        self.head_sizes, self.tail_sizes = (sorted({len(x) for x in side}) for side in (after, before))
        self.shortest, self.longest = least - 1, max(map(len, terms), default=-1) + 1
        self.least = least // 2
        self.starts, self.ends = {h[:self.least] for h in after}, {t[-self.least:] for t in before}

    def may_hold(self, word: str) -> bool:
        """Whether ``word`` begins or ends as a half of a term may, so that a lookup may succeed."""
        return self.shortest <= len(word) <= self.longest and (word[:self.least] in self.starts or word[-self.least:] in self.ends)

    def best(self, word: str) -> float:
        got = 0.0
        for k in self.head_sizes:
            if trie := self.after.get(word[:k]):
                got = max(got, search(trie, word[k:]))
        for k in self.tail_sizes:
            if trie := self.before.get(word[-k:]):
                got = max(got, search(trie, word[:-k][::-1]))
        return got


class Lexicon:
    """Terms with strengths, and cached fuzzy lookups in tries of their halves, one
    pair of tries for each band of term lengths.  Words of ``known`` are ordinary
    words near a short term."""

    def __init__(self, terms: dict[str, float], known: frozenset[str] = frozenset()):
        self.terms, self.known = terms, known
        bands = ((FUZZY_LENGTH, None), (SHORT_LENGTH, FUZZY_LENGTH), (2, SHORT_LENGTH))
        self.bands = [Halves({t: s for t, s in terms.items() if least <= len(t) and (over is None or len(t) < over)}, least)
                      for least, over in bands]
        self.cache: dict[str, tuple[int, float]] = {}

    def near(self, words: set[str]) -> list[str]:
        """The words for which a lookup may succeed."""
        used = [h.may_hold for h in self.bands if h.after]
        return [w for w in words if any(may(w) for may in used)]

    def misspelled(self, word: str) -> tuple[int, float]:
        """(band, strength) of the best term within one edit of ``word`` in the
        longest band that has one; strength 0 if none has."""
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            got = 0, 0.0
            for k, h in enumerate(self.bands):
                if h.may_hold(word) and not (k and word in self.known) and (s := h.best(word)):
                    got = k, s
                    break
            self.cache[word] = got
        return got

    def fuzzy(self, word: str) -> float:
        """Strength of the best term of ``FUZZY_LENGTH`` or more characters within one edit of ``word``, else 0."""
        k, s = self.misspelled(word)
        return 0.0 if k else s


def search(trie: dict, word: str) -> float:
    """Best strength in ``trie`` within one edit of ``word``: automaton and trie
    advance together, and a branch that the automaton can't accept is left."""
    auto, best = LevenshteinAutomaton(word), 0.0
    todo = [(trie, auto.start())]
    while todo:
        node, state = todo.pop()
        for ch, child in node.items():
            if ch == "":
                if auto.accepts(state):
                    best = max(best, child)
                continue
            nxt = auto.step(state, ch)
            if auto.alive(nxt):
                todo.append((child, nxt))
    return best


def features(text: str, lex: Lexicon) -> list[float]:
    """Sums over hits: plain exact, plain misspelled, quoted, abusive context, density."""
    return all_features(text, lex)[:5]


def all_features(text: str, lex: Lexicon) -> list[float]:
    """``features``, then plain misspelled hits of terms of four and five characters and of shorter ones."""
    low = text.lower()
    words = WORD.findall(low)
    distinct = set(words)
    # band of a misspelled term, None of an exact one
    strength = {w: (s, k) for w in lex.near(distinct) for k, s in [lex.misspelled(w)] if s}
    strength.update((w, (lex.terms[w], None)) for w in distinct & lex.terms.keys())
    if not strength:
        return [0.0] * 7
    at = [i for i, w in enumerate(words) if w in strength]
    spans = [m.span() for m in WORD.finditer(low)]
    exact = quoted = abusive = 0.0
    fuzzy = [0.0] * len(lex.bands)
    hits = set(at)
    for i in at:
        s, band = strength[words[i]]
        a, b = max(0, i - AROUND), min(len(words), i + AROUND + 1)
        before = len(QUOTES.findall(low, spans[a][0], spans[i][0]))
        after = len(QUOTES.findall(low, spans[i][1], spans[b - 1][1] + 2))
        around = words[a:i] + words[i + 1:b]
        if before % 2 and after or any(w in REPORTING for w in around[-2 * AROUND:]) and (before or after):
            quoted += s
            continue
        if band is None:
            exact += s
        else:
            fuzzy[band] += s
        if any(w in ADDRESS for w in around) or any(k in hits for k in range(a, b) if k != i):
            abusive += s
    total = exact + sum(fuzzy) + quoted
    return [math.log1p(exact), math.log1p(fuzzy[0]), math.log1p(quoted), math.log1p(abusive), total / (len(words) + 20.0),
            *map(math.log1p, fuzzy[1:])]


def with_misspellings(text: str, terms: dict[str, float]) -> str:
    """``text`` in lower case with every term of two or more characters one edit
    away: a character doubled, left out or replaced, at changing places."""
    hits = 0

    def change(m: re.Match) -> str:
        nonlocal hits
        word = m[0]
        if word not in terms or len(word) < 2:
            return word
        hits += 1
        i = (hits + len(word) // 2) % len(word)
        return word[:i] + (word[i] * 2, "", "0")[hits % 3] + word[i + 1:]
    return WORD.sub(change, text.lower())


def fold(doc_id: Column, parts: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


class ToxicityModel:
    def __init__(self, terms: dict[str, float], weights: list[float], bias: float | None,
                 known: frozenset[str] = frozenset()):
        self.terms, self.weights, self.bias, self.known = terms, weights, bias, known

    def scorer(self):
        lex = Lexicon(self.terms, self.known)

        def score(text: str | None) -> float:
            if self.bias is None:
                return 0.0
            z = self.bias + sum(w * x for w, x in zip(self.weights, all_features(text or "", lex)))
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))
        return score


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, fit_rows: int) -> DataFrame:
    """(doc_id, toxic, part, text): the bounded sample of labelled rows."""
    marks = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
             .where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .withColumn("part", fold(F.col("doc_id"), 5)).where("part <> 0"))
    some = first_by_hash(marks, "toxic", "doc_id", fit_rows)
    return id_text(docs, id_col, text_col).join(F.broadcast(some), "doc_id").dropDuplicates(["text"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        fit_rows: int = FIT_ROWS) -> ToxicityModel:
    rows = stored(sample(docs, labels, id_col, text_col, fit_rows), "toxicity-sample")
    own = rows.where("part <> 4")
    sizes = {r.toxic: r.n for r in own.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel({}, [], None)

    def words(batch: pa.RecordBatch) -> dict:
        out, sides, mark = [], [], []
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            every = WORD.findall(text.lower())
            # each word with the words around one of its places
            found = dict(zip(every, zip([""] + every, every[1:] + [""])))
            out.extend(found)
            sides.extend(" ".join(x) for x in found.values())
            mark.extend([y] * len(found))
        return {"word": out, "sides": sides, "toxic": mark}
    odds = (F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0)))
    placed = (map_rows(own.select("text", "toxic"), words, "word string, sides string, toxic int", max_rows=1000)
              .select("word", "toxic", F.xxhash64("sides").alias("sides")).distinct())
    counted = stored(placed.groupBy("word").agg(F.sum(F.col("toxic")).alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
                     .where((F.col("t") >= MIN_DOCS) | (F.col("c") >= MIN_DOCS)).withColumn("odds", odds), "toxicity-words")
    # a few words of the bounded sample, however many documents there are
    terms = counted.where((F.col("t") >= MIN_DOCS) & (F.col("odds") >= MIN_ODDS))
    found = {r.word: float(min(r.odds, 8.0)) / 8.0 for r in terms.select("word", "odds").collect()}
    known = _ordinary(counted.where((F.col("c") >= MIN_DOCS) & (F.col("odds") < MIN_ODDS)), found)
    # a fold without both labels can't weigh: then all of the sample does
    kinds = rows.where("part = 4").select("toxic").distinct().count()
    weights, bias = _weights(rows.where("part = 4") if kinds == 2 else rows, found, known)
    return ToxicityModel(found, weights, bias, known)


def _ordinary(words: DataFrame, terms: dict[str, float]) -> frozenset[str]:
    """Those of ``words`` that lie within one edit of a short term."""
    def run(batch: pa.RecordBatch) -> dict:
        lex = Lexicon(terms)
        return {"word": [w for w in lex.near(set(batch.column(0).to_pylist())) if lex.misspelled(w)[0]]}
    return frozenset(r.word for r in map_rows(words.select("word"), run, "word string").collect())


def _weights(rows: DataFrame, terms: dict[str, float], known: frozenset[str]) -> tuple[list[float], float]:
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    def measure(batch: pa.RecordBatch) -> dict:
        lex, x, y = Lexicon(terms, known), [], []
        for text, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x.append(all_features(text, lex))
            y.append(mark)
            if (other := with_misspellings(text, terms)) != text.lower():
                x.append(all_features(other, lex))
                y.append(mark)
        return {"x": x, "y": y}
    data = map_rows(rows.select("text", "toxic"), measure, "x array<double>, y double")
    data = stored(data, "toxicity-features").coalesce(4)      # a bounded sample of short rows
    model = LogisticRegression(featuresCol="v", labelCol="y", maxIter=25, regParam=1e-3).fit(
        data.select("y", array_to_vector("x").alias("v")))
    return [float(w) for w in model.coefficients], float(model.intercept)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted per row of ``docs``."""
    made: list = []      # one scorer per task

    def run(batch: pa.RecordBatch) -> dict:
        if not made:
            made.append(model.scorer())
        return {"doc_id": batch.column(0), "score": [made[0](t) for t in batch.column(1).to_pylist()]}
    scored = map_rows(id_text(docs, id_col, text_col), run, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = model.scorer()
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                yield part.filter(pa.array([one(t) < 0.5 for t in part.column(at).to_pylist()], pa.bool_()))
        one = batch = part = None       # the worker goes on to other stages
        give_back()
    return docs.mapInArrow(run, docs.schema)
