"""Toxicity by a weighted finite-state grammar over clauses: lexicon, threat, target, negation and report transducers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.llm.store import remainder, small_batches, table

# Words of the grammar's closed classes, in the languages of the documents.
TARGETS = "you your yours yourself u he she they him her them his their du dich dir dein deine ihr euch sie tu te toi ton ta vous votre usted tú ti vos".split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't nobody nicht kein keine nie ne pas jamais nunca tampoco".split()
REPORTS = "said says called calls wrote quoted reported claimed told sagte schrieb dit appelé dijo llamó".split()
THREATS = "kill hurt beat punch stab destroy shoot töten schlagen tuer frapper matar golpear".split()
MODALS = "will shall would going gonna werde wirst vais voy".split()
BASE_INSULTS = "idiot moron stupid dumb loser scum trash worthless pathetic disgusting clown imbecile cretin bastard scumbag".split()

#: Classes of words, as symbols of the transducers. Insults have one symbol each step of weight.
OTHER, TARGET, NEGATION, REPORT, MODAL, THREAT, INSULT = range(7)
_CLOSED = {w: c for c, own in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (MODAL, MODALS), (THREAT, THREATS)) for w in own}

_CLAUSE = re.compile(r"[.!?;:\n|]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


@dataclass(frozen=True)
class GrammarSettings:
    """sample_rows: labelled rows to learn from, about; least_documents: toxic rows a learned word or stem needs; least_odds: its
    least log-odds; least_evidence: its least log-likelihood ratio (20: one of 100 000 entries without any meaning passes by
    chance); most_entries: of the learned lexicon, the strongest; stems: lengths of learned word beginnings; negated, reported: what a clause's weight is
    multiplied by; targeted: what is added if a target stands in the clause; threat: weight of a threat."""

    sample_rows: int = 40_000
    least_documents: int = 5
    least_evidence: float = 20.0
    least_odds: float = 4.0
    most_entries: int = 20_000
    stems: tuple[int, ...] = (4, 5, 6)
    negated: float = 0.5
    reported: float = 0.5
    targeted: float = 0.3
    threat: float = 2.0


@dataclass
class Transducer:
    """A deterministic weighted transducer over word classes.

    moves: {(state, symbol): (next state, output symbol, weight)}; a missing move stays in its state, gives the symbol on
    and costs nothing. ends: {state: weight} at the end of a clause. State 0 starts.
    """

    moves: dict[tuple[int, int], tuple[int, int, float]]
    ends: dict[int, float] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        return self.moves.get((state, symbol), (state, symbol, 0.0))


def compose(first: Transducer, second: Transducer, symbols: range) -> Transducer:
    """The transducer that feeds what the first gives out to the second; weights add up."""
    numbers, moves, ends, todo = {(0, 0): 0}, {}, {}, [(0, 0)]
    while todo:
        pair = todo.pop()
        here = numbers[pair]
        ends[here] = first.ends.get(pair[0], 0.0) + second.ends.get(pair[1], 0.0)
        for symbol in symbols:
            a, middle, w = first.step(pair[0], symbol)
            b, out, v = second.step(pair[1], middle)
            if (a, b) not in numbers:
                numbers[a, b] = len(numbers)
                todo.append((a, b))
            moves[here, symbol] = (numbers[a, b], out, w + v)
    return Transducer(moves, ends)


#: What an insult or threat became on its way: plain, or under a negation or a report, or both.
PLAIN, NEGATED, REPORTED, BOTH = 7, 8, 9, 10
_SYMBOLS = range(11)


def grammar(settings: GrammarSettings = GrammarSettings()) -> Transducer:
    """Threat, negation, report and target transducers, composed.

    threat: a modal and then a threat word make an insult symbol of their own weight; a threat word alone is none.
    negation: an insult within three words behind a negation comes out negated. report: what follows a report word in its
    clause comes out reported. target: a target in the clause adds weight if something was matched.
    """
    threat = Transducer({(0, MODAL): (1, OTHER, 0.0), (1, MODAL): (1, OTHER, 0.0), (1, THREAT): (0, INSULT, settings.threat), (0, THREAT): (0, OTHER, 0.0)})
    negation = Transducer({(s, NEGATION): (3, NEGATION, 0.0) for s in range(4)} | {
        (s, x): (s - 1, NEGATED if x == INSULT else x, 0.0) for s in range(1, 4) for x in (OTHER, TARGET, REPORT, INSULT)} | {(0, INSULT): (0, PLAIN, 0.0)})
    report = Transducer({(0, REPORT): (1, REPORT, 0.0), (1, PLAIN): (1, REPORTED, 0.0), (1, NEGATED): (1, BOTH, 0.0)})
    hits = (PLAIN, NEGATED, REPORTED, BOTH)
    target = Transducer({(0, TARGET): (1, TARGET, 0.0), (2, TARGET): (3, TARGET, 0.0)} | {(0, h): (2, h, 0.0) for h in hits} | {(1, h): (3, h, 0.0) for h in hits},
                        {3: settings.targeted})
    out = threat
    for part in (negation, report, target):
        out = compose(out, part, _SYMBOLS)
    return out


class Scorer:
    """Weights of a text's matched clauses."""

    def __init__(self, lexicon: dict[str, float], settings: GrammarSettings = GrammarSettings()):
        self.lexicon, self.machine = lexicon, grammar(settings)
        self.stems, self.factor = settings.stems, {PLAIN: 1.0, NEGATED: settings.negated, REPORTED: settings.reported, BOTH: settings.negated * settings.reported}
        #: Finds all places where an entry may begin, in one pass; few texts have one.
        self.entries = ahocorasick.Automaton()
        for word in [*lexicon, *THREATS]:
            self.entries.add_word(word.rstrip("*"), len(word.rstrip("*")))
        self.entries.make_automaton()

    def begins(self, text: str) -> list[int]:
        """Places in a text where a word begins that an entry begins with, ascending."""
        found = {end - size + 1 for end, size in self.entries.iter(text)}
        return sorted(at for at in found if not at or not text[at - 1].isalpha())

    def weight(self, word: str) -> float:
        """Weight of a word as an insult: its own entry or its strongest stem's."""
        best = self.lexicon.get(word, 0.0)
        for n in self.stems:
            best = max(best, self.lexicon.get(word[:n] + "*", 0.0)) if len(word) >= n else best
        return best

    def clauses(self, text: str) -> list[float]:
        """The weights of the clauses that match."""
        text, out = text.lower(), []
        begins = self.begins(text)
        if not begins:
            return out
        done = -1
        for at in begins:
            if at < done:
                continue
            before = [m.end() for m in _CLAUSE.finditer(text, max(0, done), at)]
            start = before[-1] if before else max(0, done)
            after = _CLAUSE.search(text, at)
            done = after.end() if after else len(text)
            clause = text[start : after.start() if after else done]
            state, total, hits = 0, 0.0, 0
            for word in _WORD.findall(clause):
                own = self.weight(word)
                symbol = INSULT if own else _CLOSED.get(word, OTHER)
                state, given, extra = self.machine.step(state, symbol)
                if given in self.factor:
                    total += (own or extra) * self.factor[given]
                    hits += 1
            if hits:
                out.append(total + self.machine.ends.get(state, 0.0))
        return out

    def total(self, text: str | None) -> float:
        return sum(self.clauses(text)) if text else 0.0


def learn_lexicon(labelled: DataFrame, settings: GrammarSettings = GrammarSettings()) -> dict[str, float]:
    """Words and stems (`stem*`) that stand in toxic rows far more often than in others, with a weight of 0.5 to 2.

    labelled: text and toxic. Counts are over all rows given; each row counts a word once, and a stem counts its words' rows.
    The strongest `most_entries`
    are kept, a documented bound of the model. Fixed insults that the rows don't speak of keep the weight 0.5.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]+)"), 1))
    rows = labelled.where("text is not null and toxic is not null").select("toxic", words.alias("words"))
    counts = table(rows.select("toxic", F.explode("words").alias("entry")).groupBy("entry").agg(
        F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") != 1).alias("good")), "word-counts")
    sums = labelled.where("text is not null").agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    bad, good = sums[0] + 1.0, sums[1] + 1.0
    stems = counts.select(F.explode(F.array(*[F.when(F.length("entry") >= n, F.concat(F.substring("entry", 1, n), F.lit("*"))) for n in settings.stems])).alias("entry"), "bad", "good")
    counts = counts.unionByName(stems.where("entry is not null").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    odds = F.log((F.col("bad") + 0.5) / bad) - F.log((F.col("good") + 0.5) / good)
    # G, as entries are told by their own counts: a share of all toxic rows would lose rare words of a large sample
    n, all_rows = F.col("bad") + F.col("good"), bad + good
    part = lambda seen, own: F.when(seen > 0, seen * F.log(seen * all_rows / (n * own))).otherwise(0.0)
    evidence = 2 * (part(F.col("bad"), bad) + part(F.col("good"), good))
    # a clean row with the entry must be rarer than a toxic one, however rare toxic rows are
    found = counts.where((F.col("bad") >= settings.least_documents) & (evidence >= settings.least_evidence) & (odds >= settings.least_odds) & (F.col("bad") > 20 * F.col("good"))).select(
        "entry", odds.alias("odds")).orderBy(F.desc("odds"), "entry").limit(settings.most_entries).collect()
    lexicon = {w: 0.5 for w in BASE_INSULTS}
    lexicon.update({r.entry: min(2.0, max(0.5, r.odds / 3)) for r in found})
    return lexicon


def _scored(docs: DataFrame, lexicon: dict[str, float], settings: GrammarSettings) -> DataFrame:
    """Adds weight, the sum over the whole text's matched clauses, to docs (column text)."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value, settings)
        for batch in batches:
            found = [scorer.total(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "weight"])

    kept = docs.drop("weight")
    return kept.mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields], "weight double"]))


def calibrate(weights: DataFrame) -> tuple[float, float]:
    """Slope and offset of a logistic curve from weight to the chance of a toxic label.

    weights: weight and toxic. Rows are gathered in steps of weight (a tenth, up to 10) first, so the fit sees 101 counts.
    """
    step = F.least(F.round(F.col("weight"), 1), F.lit(10.0))
    rows = weights.where("toxic is not null").groupBy(step.alias("x")).agg(
        F.count_if(F.col("toxic") == 1).alias("bad"), F.count("*").alias("n")).collect()
    if not rows:
        return 4.0, -1.0
    x, bad, n = (np.array([float(r[c]) for r in rows]) for c in ("x", "bad", "n"))
    slope, offset = 1.0, -1.0
    for _ in range(50):  # Newton steps with a little ridge
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = n * p * (1 - p)
        gradient = np.array([((bad - n * p) * x).sum() - 0.1 * slope, (bad - n * p).sum() - 0.1 * offset])
        hessian = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        move = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        slope, offset = slope + move[0], offset + move[1]
    return max(0.1, float(slope)), float(offset)


def toxicity(docs: DataFrame, labels: DataFrame, settings: GrammarSettings = GrammarSettings()) -> DataFrame:
    """doc_id, held_out, score, predicted, weight of every document.

    Learns from a bounded sample of the labelled documents whose crc32 of the id modulo 5 is not 0. A text without a match, empty or null text has
    the curve's score at weight 0. Documents with several labels count once for each; null labels not at all.
    """
    rows = docs.select("doc_id", "text")
    known = labels.where("toxic is not null and doc_id is not null").select("doc_id", "toxic").where(remainder("doc_id", 5) != 0)
    share = settings.sample_rows / max(1, known.count())
    place = F.shiftrightunsigned(F.xxhash64(F.lit(13), "doc_id"), 11) / float(1 << 53)
    # the limit proves that the list is small enough to send; the share alone keeps it near half of that
    sample = known.where(place < share).limit(2 * settings.sample_rows)
    taught = table(rows.join(F.broadcast(sample), "doc_id").select("text", "toxic"), "labelled")
    lexicon = learn_lexicon(taught, settings)
    slope, offset = calibrate(_scored(taught.select("text", "toxic"), lexicon, settings))
    scored = _scored(rows, lexicon, settings)
    score = 1 / (1 + F.exp(-(F.col("weight") * slope + offset)))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "weight")
