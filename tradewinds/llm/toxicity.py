"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters look at a whole text and say yes or no. Lexicon voters: general insults per language, and
word openings of 4 to 8 bytes that labelled toxic documents have, or have densely (at least twice and
once in `DENSE_WORDS` words), and others do not (each length votes for itself, once for presence and
once for density). Pattern voters: several distinct insults, insults close
together, an insult near a pronoun that addresses someone, disguised spellings.

The label model is fitted on the counts of vote patterns over all documents, which are at most
2 ** voters rows (65,536) and in practice a few hundred. Voters that depend on each other beyond what the
class explains form groups (`fit_label_model`), and expectation maximisation estimates the share of toxic
documents and, in both classes, every voter's hit rate or every group's rate of each joint vote, so that
voters that repeat each other count once. The votes on the labelled sample hold the classes in place.
Its posteriors label a bounded sample of documents (`FIT_DOCS` of either kind, the lowest id
hashes), and a logistic regression over hashed word openings learns from them, restricted to features
with a clear share in one class. Its probability is the score.

Labels come from a bounded sample of up to `SAMPLE_DOCS` labelled documents of each class that are
not held out.

Defined cases: null text is empty; the empty text has the score of the offset; without labelled
documents of both classes only the general lexicons and patterns vote; without any vote the score is
0; labels other than 0 and 1 are not learned from; rows that repeat get a row each; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm.frames import documents, held_out, map_documents, sampled, stage
from tradewinds.llm.linear import sigmoid
from tradewinds.llm.text import CLEAN, Words, as_bytes, begins, blocks, joined

SAMPLE_DOCS = 1_500
FIT_DOCS = 2_000
OPENING_BYTES = (4, 5, 6, 8)
FEATURES = 2**20
#: An opening is in a learned list if so many more times as many toxic documents have it.
RATIO = 30.0
LEAST_DOCS = 4
DENSE_WORDS = 150
#: From this posterior on a text is an example of a toxic one, below one half of a clean one; others are no examples.
SURE = 0.95
NEAR_WORDS = 6
#: Voters may be one group from the start if so many of the texts that either marks are marked by both.
SAME_VOTES = (0.97, 0.8, 0.6, 0.4)
#: Voters of a group at most, and pairs of groups tried by each of two measures before one is joined.
GROUP_VOTERS = 10
TRIED_PAIRS = 6

# General insults by language.
INSULTS = {
    "en": "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown "
          "imbecile dumb jerk bastard asshole bitch fool fools garbage vermin",
    "de": "idiot idioten dumm dummkopf trottel arschloch abschaum widerlich wertlos versager depp schwachkopf",
    "fr": "idiot idiote imbécile crétin crétine connard connasse ordure minable pathétique abruti débile",
    "es": "idiota idiotas imbécil estúpido estúpida basura escoria patético asqueroso inútil payaso pendejo",
}
# Pronouns that address someone.
PRONOUNS = "you your youre du dich dir ihr euch tu te toi vous ustedes usted tú vosotros"

# Characters that stand for letters in disguised spellings.
_PLAIN = CLEAN.copy()
for _sign, _letter in zip(b"0134578@$!", b"oieastbasi"):
    _PLAIN[_sign] = _letter


def _hashes(words: str) -> np.ndarray:
    return np.unique(Words(CLEAN[joined([as_bytes(words.lower())])]).hashes())


_LEXICONS = [_hashes(words) for words in INSULTS.values()]
_ANY_INSULT = np.unique(np.concatenate(_LEXICONS))
_ADDRESS = _hashes(PRONOUNS)


class _Member:
    """Which of many hashes are in a small list; a bit table leaves few to look up."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.unique(values)
        self.table = np.zeros(2**16, bool)
        self.table[(self.values & np.uint64(0xFFFF)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        found = self.table[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
        found[found] = np.isin(hashes[found], self.values)
        return found


def _any_in(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[at[1:]] > total[at[:-1]]


def _openings(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray, list[np.ndarray], np.ndarray]]:
    """Blocks of texts: the bytes, whole-word hashes, hashes of word openings by length, where texts begin."""
    for _, block in blocks([(t or "").lower() for t in texts]):
        words = Words(CLEAN[joined(block)])
        yield block, words.hashes(), [words.hashes(n) for n in OPENING_BYTES], begins(block, words.starts)


def _present_and_dense(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of one text's words, and those of them that are dense in it."""
    found, counts = np.unique(hashes, return_counts=True)
    return found, found[(counts >= 2) & (counts * DENSE_WORDS >= len(hashes))]


def _feature_rows(texts: list[str | None]) -> Iterator[np.ndarray]:
    for _, _, openings, at in _openings(texts):
        for begin, end in zip(at[:-1], at[1:]):
            own = []
            for h in openings:
                present, dense = _present_and_dense(h[begin:end])
                own += [present, dense * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)]
            yield np.unique(np.concatenate(own) % np.uint64(FEATURES)).astype(np.int32)


@dataclass
class Voters:
    """Learned lists of opening hashes: (position in OPENING_BYTES, whether they must be dense, hashes)."""

    learned: list[tuple[int, bool, np.ndarray]]

    def votes(self, texts: list[str | None]) -> np.ndarray:
        """A bit for every voter that says yes, by text."""
        insult, address = _Member(_ANY_INSULT), _Member(_ADDRESS)
        lexicons, learned = [_Member(x) for x in _LEXICONS], [(n, dense, _Member(h)) for n, dense, h in self.learned]
        out = []
        for block, words, openings, at in _openings(texts):
            said = [_any_in(member(words), at) for member in lexicons]
            for n, dense, member in learned:
                total = np.concatenate([[0], np.cumsum(member(openings[n]))])
                hit = total[at[1:]] - total[at[:-1]]
                said.append((hit >= 2) & (hit * DENSE_WORDS >= at[1:] - at[:-1]) if dense else hit > 0)
            hits = np.flatnonzero(insult(words))
            text = np.searchsorted(at, hits, side="right") - 1
            several = np.zeros(len(at) - 1, bool)
            pairs = np.unique(np.stack([text, (words[hits] % np.uint64(2**62)).astype(np.int64)], 1), axis=0)[:, 0]
            several[pairs[1:][pairs[1:] == pairs[:-1]]] = True
            close = np.zeros(len(at) - 1, bool)
            close[text[1:][(text[1:] == text[:-1]) & (hits[1:] - hits[:-1] <= 40)]] = True
            addressed = np.flatnonzero(address(words))
            near = np.zeros(len(at) - 1, bool)
            if len(addressed) and len(hits):
                after = np.searchsorted(addressed, hits)
                for k in (after - 1, after):
                    k = np.clip(k, 0, len(addressed) - 1)
                    ok = (np.abs(addressed[k] - hits) <= NEAR_WORDS) & (np.searchsorted(at, addressed[k], side="right") - 1 == text)
                    near[text[ok]] = True
            plain = Words(_PLAIN[joined(block)])
            disguised = _any_in(insult(plain.hashes()), begins(block, plain.starts)) & ~_any_in(insult(words), at)
            said += [several, close, near, disguised]
            out.append(sum(s.astype(np.int64) << k for k, s in enumerate(said)))
        return np.concatenate([*out, np.empty(0, np.int64)])

    @property
    def count(self) -> int:
        return len(_LEXICONS) + len(self.learned) + 4


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [[x.tobytes() for h in openings for x in _present_and_dense(h[b:e])]
                 for _, _, openings, at in _openings(list(batch["text"])) for b, e in zip(at[:-1], at[1:])]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "rows": found})


def known_sample(labels: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    """doc_id and label of up to `SAMPLE_DOCS` rows of each class that are not held out."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .where("label IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"), parts, part))
        .withColumn("text", F.lit(""))
    )
    return sampled(known, SAMPLE_DOCS, "label").drop("text")


def learn_voters(docs: DataFrame, sample: DataFrame) -> Voters:
    # At most 2 * SAMPLE_DOCS ids, so they can be sent to where the texts are.
    found = map_documents(documents(docs).join(F.broadcast(sample), "doc_id"), _rows, "doc_id bigint, label int, rows array<binary>").collect()
    labels_found = np.array([r.label for r in found])
    if len(set(labels_found.tolist())) < 2:
        return Voters([])
    learned, sizes = [], {c: (labels_found == c).sum() for c in (0, 1)}
    for k in range(2 * len(OPENING_BYTES)):
        values, counts = {}, {}
        for c in (0, 1):
            every = [np.frombuffer(bytes(r.rows[k]), np.uint64) for r in found if r.label == c]
            values[c], counts[c] = np.unique(np.concatenate(every), return_counts=True)
        clean = np.zeros(len(values[1]))
        if len(values[0]):
            at = np.minimum(np.searchsorted(values[0], values[1]), len(values[0]) - 1)
            clean = np.where(values[0][at] == values[1], counts[0][at], 0)
        ratio = ((counts[1] + 0.1) / sizes[1]) / ((clean + 0.1) / sizes[0])
        chosen = values[1][(ratio >= RATIO) & (counts[1] >= LEAST_DOCS)]
        if len(chosen):
            learned.append((k // 2, k % 2 == 1, chosen))
    return Voters(learned)


def _bits(patterns: np.ndarray, voters: int) -> np.ndarray:
    return (np.asarray(patterns, np.int64)[:, None] >> np.arange(voters)) & 1


def _category(said: np.ndarray, group: list[int]) -> np.ndarray:
    """The votes of a group's members as one number."""
    return said[:, group] @ (1 << np.arange(len(group)))


@dataclass
class LabelModel:
    """Log odds of a vote pattern: an offset plus, for every group of dependent voters, those of its joint vote."""

    share: float
    yes: np.ndarray  # log odds of a voter's yes on its own
    no: np.ndarray
    trust: np.ndarray  # 1 for a voter on its own, less for voters that repeat others
    groups: list[list[int]]
    odds: list[np.ndarray]  # by group: log odds of every joint vote of its members

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        said = _bits(patterns, len(self.yes))
        odds = np.full(len(said), np.log(self.share / (1 - self.share)))
        for group, own in zip(self.groups, self.odds):
            odds += own[_category(said, group)]
        return sigmoid(odds)


def _fit_groups(said: np.ndarray, weight: np.ndarray, known: np.ndarray, groups: list[list[int]], rounds: int) -> tuple[float, float, list, np.ndarray]:
    """Expectation maximisation with independent groups whose members vote jointly in any way.

    Where `known` (weights of patterns of texts known to be toxic, and to be clean) has both classes, the rates of
    a class are the means of those among known texts and those among all. Every yes, alone or jointly, speaks
    for toxic. Returns the penalised likelihood, the share, by group the joint votes' probabilities if toxic and if clean, and
    every pattern's posterior.
    """
    categories = [_category(said, g) for g in groups]
    sizes = [1 << len(g) for g in groups]
    members = [_bits(np.arange(n), len(g)).astype(bool) for g, n in zip(groups, sizes)]
    # Start from groups counted once each, so that voters that repeat each other are no agreement.
    agree = sum((c > 0).astype(int) for c in categories)
    p = np.where(agree >= 2, 0.95, np.where(agree == 1, 0.3, 0.01))
    if known.sum(1).all():
        known = known / known.sum(1, keepdims=True)
    else:
        known = np.zeros_like(known)
    for step in range(rounds):
        toxic, clean = weight * p, weight * (1 - p)
        share = min(max((toxic.sum() + 1) / (weight.sum() + 10), 1e-4), 0.5)
        n1, n0 = toxic.sum(), clean.sum()
        if known.any():
            # The first round knows known texts only.
            toxic, clean = (n * k + (w if step else 0) for n, k, w in ((n1, known[0], toxic), (n0, known[1], clean)))
            n1, n0 = toxic.sum(), clean.sum()
        hit, false = (toxic @ said + 1) / (n1 + 10), (clean @ said + 0.1) / (n0 + 10)
        false = np.minimum(false, hit / 2)
        tables, odds, likely = [], np.full(len(p), np.log(share / (1 - share))), np.full(len(p), np.log(1 - share))
        for group, c, size, yes in zip(groups, categories, sizes, members):
            if len(group) == 1:
                k = group[0]
                table = np.array([[1 - hit[k], hit[k]], [1 - false[k], false[k]]])
            else:
                # A joint vote that is rare or was never seen is drawn to what independent members would give.
                alone = [np.where(yes, r[group], 1 - r[group]).prod(1) for r in (hit, false)]
                table = np.array([
                    (np.bincount(c, w, size) + prior) / (w.sum() + 1) for w, prior in ((toxic, alone[0]), (clean, alone[1]))
                ])
                table[1, 1:] = np.minimum(table[1, 1:], table[0, 1:] / 2)
                table[1, 0] = 1 - table[1, 1:].sum()
            tables.append(table)
            odds += np.log(table[0] / table[1])[c]
            likely += np.log(table[1])[c]
        new = sigmoid(odds)
        done = step > 5 and np.abs(new - p).max() < 1e-6
        p = new
        if done:
            break
    total = (weight * (likely + np.logaddexp(0, odds))).sum()
    parameters = 1 + 2 * sum(len(np.unique(c)) - 1 for c in categories)
    return total - parameters / 2 * np.log(max(weight.sum(), 2)), share, tables, p


def _association(said: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Correlations of the voters' votes."""
    d = said - np.average(said, axis=0, weights=weight)
    moments = (d * weight[:, None]).T @ d
    scale = np.sqrt(np.maximum(np.diag(moments), 1e-9))
    return moments / np.outer(scale, scale)


def _merged(groups: list[list[int]], a: int, b: int) -> list[list[int]]:
    return [g for k, g in enumerate(groups) if k not in (a, b)] + [sorted(groups[a] + groups[b])]


def _alike(said: np.ndarray, weight: np.ndarray, least: float) -> list[list[int]]:
    """Groups of voters that say the same of all but a few of the texts that either marks."""
    both = (said * weight[:, None]).T @ said
    either = np.diag(both)[:, None] + np.diag(both)[None, :] - both
    alike = both >= least * np.maximum(either, 1)
    groups: list[list[int]] = []
    for k in range(said.shape[1]):
        near = [g for g in groups if any(alike[k, j] for j in g)]
        groups = [g for g in groups if g not in near] + [sorted([k, *(j for g in near for j in g)])]
    return groups


def _joined(said: np.ndarray, weight: np.ndarray, known: np.ndarray, groups: list[list[int]], rounds: int) -> tuple[tuple, list[list[int]]]:
    """Groups joined two by two as long as that pays, and the model fitted with them; with fewer than three, any class fits."""
    best, association = _fit_groups(said, weight, known, groups, rounds), np.abs(_association(said, weight))
    while len(groups) > 3:
        pairs = [(a, b) for a in range(len(groups)) for b in range(a) if len(groups[a]) + len(groups[b]) <= GROUP_VOTERS]
        p = best[3]
        within = [_association(said, np.maximum(weight * share, 1e-12)) for share in (p, 1 - p)]
        linked = {ab: max(association[i, j] for i in groups[ab[0]] for j in groups[ab[1]]) for ab in pairs}
        apart = {ab: max(abs(w[i, j]) for w in within for i in groups[ab[0]] for j in groups[ab[1]]) for ab in pairs}
        tried = {ab for seen in (linked, apart) for ab in sorted(pairs, key=seen.get, reverse=True)[:TRIED_PAIRS]}
        found = [(_fit_groups(said, weight, known, _merged(groups, *ab), rounds), ab) for ab in sorted(tried)]
        if not found or max(found, key=lambda f: f[0][0])[0][0] <= best[0]:
            break
        best, (a, b) = max(found, key=lambda f: f[0][0])
        groups = _merged(groups, a, b)
    return best, groups


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, voters: int, rounds: int = 200,
                    known: np.ndarray | None = None) -> LabelModel:
    """Accuracies and correlations of the voters from how often each pattern of votes occurs.

    Dependence is sought apart from the class, from several starts: voters that mostly say the same are one
    group to begin with; then, again and again, the two groups are joined whose joint voting explains the
    patterns best, with the whole model fitted anew each time, until the likelihood no longer pays for the
    parameters. The start that ends with the best penalised likelihood wins. `known`: how many texts of each
    pattern are known to be toxic, and to be clean.
    """
    said, weight = _bits(patterns, voters), np.asarray(counts, float)
    known = np.zeros((2, len(weight))) if known is None else np.asarray(known, float)
    starts = []
    for least in SAME_VOTES:
        groups = _alike(said, weight, least)
        if groups not in starts and max(map(len, groups)) <= GROUP_VOTERS:
            starts.append(groups)
    best, groups = max((_joined(said, weight, known, groups, rounds) for groups in starts), key=lambda found: found[0][0])
    _, share, tables, p = best
    toxic, clean = weight * p, weight * (1 - p)
    hit = (toxic @ said + 1) / (toxic.sum() + 10)
    false = np.minimum((clean @ said + 0.1) / (clean.sum() + 10), hit / 2)
    trust = np.ones(voters)
    for group in groups:
        if len(group) > 1:
            # A voter's residual correlations with the others of its group: three copies have a third each.
            residual = sum(np.clip(_association(said, np.maximum(w, 1e-12)), 0, 1) * w.sum() for w in (toxic, clean)) / weight.sum()
            trust[group] = 1 / residual[np.ix_(group, group)].sum(1).clip(1)
    odds = [np.log(t[0] / t[1]) for t in tables]
    return LabelModel(share, np.log(hit / false), np.log((1 - hit) / (1 - false)), trust, groups, odds)


@dataclass
class Classifier:
    features: np.ndarray
    weights: np.ndarray
    offset: float

    def scores(self, rows: Iterator[np.ndarray]) -> np.ndarray:
        table = np.zeros(FEATURES, np.float32)
        table[self.features] = self.weights
        return np.array([float(sigmoid(table[r].sum() + self.offset)) for r in rows], float)


def _fit_classifier(rows: list[np.ndarray], target: np.ndarray, share: float, rounds: int = 300) -> Classifier:
    """Logistic regression on posterior labels by gradient steps, over the features with a clear share."""
    soft = {c: np.zeros(FEATURES) for c in (0, 1)}
    for row, p in zip(rows, target):
        soft[1][row] += p
        soft[0][row] += 1 - p
    ratio = ((soft[1] + 0.1) / max(target.sum(), 1)) / ((soft[0] + 0.1) / max((1 - target).sum(), 1))
    chosen = np.flatnonzero((ratio >= RATIO / 3) & (soft[1] >= LEAST_DOCS))
    number = np.full(FEATURES, -1, np.int64)
    number[chosen] = np.arange(len(chosen))
    columns = [number[r][number[r] >= 0] for r in rows]
    at = np.repeat(np.arange(len(rows)), list(map(len, columns)))
    column = np.concatenate([*columns, np.empty(0, np.int64)])
    weights, offset = np.zeros(len(chosen)), 0.0
    g2, o2 = np.full(len(chosen), 1e-6), 1e-6
    importance = np.where(target > 0.5, share / max(target.mean(), 1e-9), (1 - share) / max(1 - target.mean(), 1e-9))
    importance /= importance.mean()
    for _ in range(rounds):
        score = np.bincount(at, weights[column], len(rows)) + offset
        error = (sigmoid(score) - target) * np.maximum(importance, 0.2)
        slope = np.bincount(column, error[at], len(chosen)) + 0.02 * weights
        g2 += slope**2
        o2 += error.sum() ** 2
        weights -= 0.5 * slope / np.sqrt(g2)
        offset -= 0.5 * error.sum() / np.sqrt(o2)
    return Classifier(chosen, weights.astype(np.float32), float(offset))


@dataclass
class Model:
    voters: Voters
    labels: LabelModel
    classifier: Classifier


def fit(docs: DataFrame, labels: DataFrame, parts: int = 4, part: int = 2) -> Model:
    """Voters from labelled documents, their accuracies from these and all others, the classifier from posteriors."""
    sample = stage(known_sample(labels, parts, part), "known")
    voters = learn_voters(docs, sample)

    def voting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "pattern": voters.votes(list(batch["text"]))})

    voted = stage(map_documents(documents(docs), voting, "doc_id bigint, pattern bigint"), "votes")
    seen = voted.groupBy("pattern").count().orderBy("pattern").collect()
    patterns, counts = np.array([r.pattern for r in seen], np.int64), np.array([r["count"] for r in seen])
    if not len(seen) or not patterns.any():
        none = np.zeros(voters.count)
        return Model(voters, LabelModel(1e-4, none, none, none, [], []), Classifier(np.empty(0, np.int64), np.empty(0, np.float32), -40.0))
    by_class = voted.join(F.broadcast(sample), "doc_id").groupBy("pattern", "label").count().collect()
    known = np.zeros((2, len(patterns)))
    for r in by_class:
        known[1 - r.label, np.searchsorted(patterns, r.pattern)] += r["count"]
    labelling = fit_label_model(patterns, counts, voters.count, known=known)
    posterior = labelling.posterior(patterns)
    # At most 2 ** voters rows (65,536). Without any vote the posterior is the same for all; such texts are the clean sample.
    classes = docs.sparkSession.createDataFrame(
        [(int(k), True if p >= SURE else False if p < 0.5 else None) for k, p in zip(patterns, posterior)],
        "pattern bigint, toxic boolean",
    )
    drawn = sampled(
        voted.where(~held_out(F.col("doc_id"), parts, part)).join(F.broadcast(classes), "pattern").withColumn("text", F.lit("")),
        FIT_DOCS, "toxic",
    ).select("doc_id").distinct()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "pattern": voters.votes(list(batch["text"])),
                "row": [r.tobytes() for r in _feature_rows(list(batch["text"]))],
            })

    found = (
        map_documents(documents(docs).join(F.broadcast(drawn), "doc_id"), rows, "doc_id bigint, pattern bigint, row binary")
        .orderBy("doc_id", "row").collect()
    )
    target = labelling.posterior(np.array([r.pattern for r in found], np.int64)) if found else np.empty(0)
    share = float((posterior * counts).sum() / counts.sum())
    return Model(voters, labelling, _fit_classifier([np.frombuffer(bytes(r.row), np.int32) for r in found], target, share))


def score(docs: DataFrame, model: Model, parts: int = 4, part: int = 2, label_from: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    classifier = model.classifier

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = classifier.scores(_feature_rows(list(batch["text"])))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": scores,
                "predicted": (scores >= label_from).astype(np.int32),
            })

    return map_documents(
        documents(docs).withColumn("held_out", held_out(F.col("doc_id"), parts, part)),
        scored, "doc_id bigint, held_out boolean, score double, predicted int"
    )
