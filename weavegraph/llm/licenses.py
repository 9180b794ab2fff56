"""License scans: a trained paragraph classifier, with template comparison confirming what it says.

Paragraphs are single lines, and runs of lines up to a blank one, as notices are often wrapped: where a whole run holds
enough of a template, its windows of lines are judged as one paragraph each; unknown licences are told by single lines.
The classifier is a multinomial logistic regression on sparse word n-grams (one to three words) over the licence families, a class of
unknown licences and one for all other text. It learns from the families' templates, each cut, joined with words of its
surroundings and thinned out in many ways; from the same with the words that only one family has replaced, and sentences
that name licences which don't exist, as unknown licences; and from paragraphs of the corpus itself without licence words
(a bounded sample by a hash of doc_id and line). Only n-grams of the templates carry weights; any other is a zero.

Made paragraphs that the fit hasn't seen calibrate: the temperature that makes their probabilities true, and the
probability below which a paragraph that looks like a licence is of an unknown family. A prediction counts as confirmed if
the paragraph holds enough of one of the family's templates' n-grams, and of those among them that no other family has;
unconfirmed ones are unknown too. Scores are sums over the n-grams that a paragraph has, of some thousand lines at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.llm.common import annotate
from weavegraph.llm.license_texts import TEMPLATES
from weavegraph.llm.mixing import count_words
from weavegraph.llm.quality import WORDS
from weavegraph.llm.shingles import mix, word_hashes

NONE, UNKNOWN = "none", "unknown"
#: A paragraph with such a word is no example of other text.
LICENCE_WORDS = r"(?i)licen[sc]e|licensed|copyright|all rights|permission|redistribut|public domain|spdx|proprietary"
RESULT = "families array<string>, unknown bigint, paragraphs array<struct<line:int,family:string,predicted:string,probability:double,template:double>>"


def ngrams(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(line, n-gram hash) of one to three words within each line, repeats kept."""
    words, counts = word_hashes([x.translate(WORDS) for x in lines])
    owner = np.repeat(np.arange(len(lines)), counts)
    k = np.uint64(0x9E3779B97F4A7C15)
    two = mix(words[:-1] * k + words[1:]) if len(words) > 1 else words[:0]
    three = mix(two[:-1] * k + words[2:]) if len(words) > 2 else words[:0]
    same2, same3 = owner[:-1] == owner[1:], owner[:-2] == owner[2:]
    return np.concatenate((owner, owner[:-1][same2], owner[:-2][same3])), np.concatenate((words, two[same2] if len(two) else two, three[same3] if len(three) else three))


#: Sentences about a licence, for names that are no family's.
SENTENCES = ("Licensed under the {} License.", "Released under the {} License, version {}.", "This work is licensed under the {} Public License, version {}.", "Licensed under the {} License, Version {}.", "Distributed under the terms of the {} Software License.", "SPDX-License-Identifier: {}-{}")


class Sparse:
    """Rows of distinct vocabulary places: `places` of row i are those from starts[i] on."""

    def __init__(self, lines: np.ndarray, places: np.ndarray):
        order = np.lexsort((places, lines))
        lines, places = lines[order], places[order]
        first = np.concatenate(([True], (lines[1:] != lines[:-1]) | (places[1:] != places[:-1]))) if len(lines) else np.zeros(0, bool)
        lines, self.places = lines[first], places[first]
        self.lines, self.starts, self.row = np.unique(lines, return_index=True, return_inverse=True)  # which lines the rows are of

    def __len__(self) -> int:
        return len(self.lines)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """Each row's sum of the weights (places by columns) of its places."""
        return np.add.reduceat(weights[self.places], self.starts, axis=0) if len(self) else np.zeros((0, weights.shape[1]))

    def rows(self, some: np.ndarray) -> Sparse:
        keep = np.isin(self.row, some)
        return Sparse(self.row[keep], self.places[keep])


class Classifier:
    """classes (the last two are unknown and none), vocabulary, weights, temperature, threshold, and the templates' n-grams by class."""

    def __init__(self, seed: int = 5):
        self.classes = [*sorted(TEMPLATES), UNKNOWN, NONE]
        texts = [(c, t.encode()) for c, name in enumerate(self.classes[:-2]) for t in TEMPLATES[name]]
        owner, grams = ngrams([t for _, t in texts])
        self.vocabulary = np.unique(grams)
        self.template_class = np.array([c for c, _ in texts])
        template = np.zeros((len(self.vocabulary), len(texts)), dtype=np.float32)
        template[np.searchsorted(self.vocabulary, grams), owner] = 1
        # Rare n-grams tell more: each weighs by how few templates have it.
        whole = template * np.log(1 + len(texts) / template.sum(axis=1, keepdims=True)).astype(np.float32)
        families = np.stack([template[:, self.template_class == c].max(axis=1) for c in range(len(self.classes) - 2)], axis=1).sum(axis=1)
        own = whole * (families == 1)[:, None]
        own[:, own.sum(axis=0) == 0] = whole[:, own.sum(axis=0) == 0]
        self.template, self.own = whole / whole.sum(axis=0), own / own.sum(axis=0)
        self.rng = np.random.default_rng(seed)
        self.temperature, self.threshold = 1.0, 0.5

    def design(self, lines: list[bytes]) -> Sparse:
        """The places of the n-grams of the vocabulary that each line has."""
        owner, grams = ngrams(lines)
        place = np.minimum(np.searchsorted(self.vocabulary, grams), len(self.vocabulary) - 1)
        known = self.vocabulary[place] == grams
        return Sparse(owner[known], place[known])

    def made(self, others: list[bytes], per_template: int = 30) -> tuple[list[bytes], np.ndarray]:
        """Training paragraphs: templates in many states, unknown licences, and others."""
        lines, labels = [], []
        families: dict[bytes, set[str]] = {}
        for name, templates in TEMPLATES.items():
            for w in " ".join(templates).encode().translate(WORDS).lower().split():
                families.setdefault(w, set()).add("GPL" if name.endswith("GPL") else name)  # these name each other
        spare = b" ".join(others).split() or [b"x"]
        draw = lambda n: b" ".join(spare[int(k)] for k in self.rng.integers(len(spare), size=n))
        for c, name in enumerate(self.classes[:-2]):
            for template in TEMPLATES[name]:
                words = template.encode().split()
                own = [len(families.get(w.translate(WORDS).strip().lower(), ())) == 1 for w in words]
                if 3 <= len(words) - sum(own) < len(words):
                    for _ in range(per_template // 2):
                        lines.append(b" ".join(spare[int(self.rng.integers(len(spare)))] if o else w for w, o in zip(words, own, strict=True)))
                        labels.append(len(self.classes) - 2)
                for i in range(per_template):
                    its = [w for w in words if i == 0 or self.rng.random() > 0.08] or words
                    if i % 3 == 1 and len(its) > 12:
                        start = int(self.rng.integers(0, len(its) - 11))
                        its = its[start : start + int(self.rng.integers(10, 30))]
                    if i % 3 == 2 and others:
                        around = others[int(self.rng.integers(len(others)))].split()[: int(self.rng.integers(1, 7))]
                        its = around + its if i % 2 else its + around
                    lines.append(b" ".join(its))
                    labels.append(c)
        for sentence in SENTENCES:
            for _ in range(per_template):
                lines.append(sentence.encode().replace(b"{}", draw(int(self.rng.integers(1, 4))), 1).replace(b"{}", str(int(self.rng.integers(1, 9))).encode()))
                labels.append(len(self.classes) - 2)
        for x in others:
            lines.append(x)
            labels.append(len(self.classes) - 1)
        common = b"the this of in is under a work to you may file with version public free any use general law rights".split()
        for _ in range(per_template * 12):  # ordinary words that templates have too
            lines.append(b" ".join(self.rng.choice(common, int(self.rng.integers(1, 14)))))
            labels.append(len(self.classes) - 1)
        return lines, np.array(labels)

    def fit(self, others: list[bytes], rounds: int = 200, ridge: float = 2e-4) -> Classifier:
        lines, labels = self.made(others)
        x = self.design(lines)
        y = labels[x.lines]
        order = self.rng.permutation(len(y))
        train, held = np.sort(order[::2]), np.sort(order[1::2])
        its, n, k = x.rows(train), len(train), len(self.classes)
        self.weights = np.zeros((len(self.vocabulary), k))
        self.bias = np.zeros(k)
        self.bias[-1] = 2.0
        first, second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        target = np.eye(k)[y[train]]
        # The same entries by place, for the slopes.
        by = np.argsort(its.places, kind="stable")
        some, starts = np.unique(its.places[by], return_index=True)
        for t in range(1, rounds + 1):
            error = (target - self._softmax(its.sums(self.weights) + self.bias)) / n
            slope = -ridge * self.weights
            slope[some] += np.add.reduceat(error[its.row[by]], starts, axis=0)
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            self.weights += 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        score, truth = x.rows(held).sums(self.weights) + self.bias, y[held]
        grid = np.geomspace(0.25, 8, 40)
        self.temperature = float(min(grid, key=lambda z: -np.log(np.maximum(self._softmax(score / z)[np.arange(len(truth)), truth], 1e-9)).mean()))
        p = self._softmax(score / self.temperature)
        guess, sure = p.argmax(axis=1), p.max(axis=1)
        wrong = np.sort(sure[(guess != truth) & (guess < k - 2)])
        # Above the threshold, at most one in a hundred of the held-out predictions is wrong.
        self.threshold = float(max(0.5, wrong[-max(1, len(truth) // 100)] if len(wrong) > len(truth) // 100 else 0.5))
        return self

    @staticmethod
    def _softmax(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def probabilities(self, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the lines that have an n-gram of the vocabulary, and their classes' probabilities."""
        x = self.design(lines)
        return x.lines, self._softmax((x.sums(self.weights) + self.bias) / self.temperature)

    def judge(self, lines: list[bytes], confirm: float = 0.5, least_rest: float = 0.5) -> list[tuple[int, str, str, float, float]]:
        """(line, family or unknown, predicted, probability, template agreement) of the lines that look like licences."""
        out = []
        for start in range(0, len(lines), 4096):
            x = self.design(lines[start : start + 4096])
            p = self._softmax((x.sums(self.weights) + self.bias) / self.temperature)
            looks = np.flatnonzero(1 - p[:, -1] >= least_rest)
            its = x.rows(looks)
            held, own = its.sums(self.template), its.sums(self.own)
            for i, row in enumerate(looks.tolist()):
                c = int(p[row, :-1].argmax())
                line = start + int(x.lines[row])
                if c == len(self.classes) - 2:
                    out.append((line, UNKNOWN, UNKNOWN, float(p[row, c]), float(held[i].max())))
                    continue
                mine = self.template_class == c
                agrees, sure = float(held[i][mine].max()), float(p[row, c])
                # What no template agrees with at all is other text with a licence's words.
                if agrees < confirm and held[i].max() < confirm / 2:
                    continue
                confirmed = ((held[i][mine] >= confirm) & (own[i][mine] >= confirm / 2)).any()
                out.append((line, self.classes[c] if sure >= self.threshold and confirmed else UNKNOWN, self.classes[c], sure, agrees))
        return out

    def wrapped(self, lines: list[bytes], owner: list[int], confirm: float = 0.5) -> list[tuple[int, int, str, str, float, float]]:
        """(first line, line behind the last, then as judge()) of families' notices that go over several lines of one text.

        What a window of lines confirms, its whole run of lines holds too, so only such runs are cut into windows. They
        grow from each line until they hold twice the words of the longest template; the best ones stay, without overlap.
        """
        blank = [not x.translate(WORDS).strip() for x in lines]
        runs, start = [], 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or blank[i] or blank[i - 1] or owner[i] != owner[i - 1]:
                if i - start > 1:
                    runs.append((start, i))
                start = i
        if not runs:
            return []
        holds = []
        for start in range(0, len(runs), 4096):
            x = self.design([b" ".join(lines[a:b]) for a, b in runs[start : start + 4096]])
            holds += (start + x.lines[x.sums(self.template).max(axis=1, initial=0) >= confirm]).tolist()
        most = 2 * max(len(t.encode().translate(WORDS).split()) for its in TEMPLATES.values() for t in its)
        spans = []
        for r in holds:
            a, b = runs[r]
            n = [len(x.translate(WORDS).split()) for x in lines[a:b]]
            for i in range(b - a):
                held = n[i]
                for j in range(i + 1, b - a):
                    held += n[j]
                    spans.append((a + i, a + j + 1))
                    if held > most:
                        break
        found = [(*spans[k], *rest) for k, *rest in self.judge([b" ".join(lines[a:b]) for a, b in spans], confirm) if rest[0] != UNKNOWN]
        out, taken = [], set()
        for hit in sorted(found, key=lambda h: (-round(h[5], 6), h[1] - h[0], h[0])):
            if taken.isdisjoint(range(hit[0], hit[1])):
                taken.update(range(hit[0], hit[1]))
                out.append(hit)
        return sorted(out)

    def scan(self, lines: list[bytes], owner: list[int]) -> list[tuple[int, str, str, float, float]]:
        """judge() of single lines and of wrapped notices, each at its first line; lines within a notice aren't told again.

        A line that is a confirmed notice by itself stays, and takes the place of a window that adds nothing to it.
        """
        single = self.judge(lines)
        alone = {line: family for line, family, *_ in single if family != UNKNOWN}
        windows = [h for h in self.wrapped(lines, owner) if h[2] not in {alone.get(i) for i in range(h[0], h[1])}]
        inside = {i for a, b, *_ in windows for i in range(a, b)}
        return sorted([x for x in single if x[1] != UNKNOWN or x[0] not in inside] + [(a, *rest) for a, _, *rest in windows])


def train(docs: DataFrame, *, text: str = "text", most_docs: int = 400, per_doc: int = 10) -> Classifier:
    """A classifier; the corpus gives its other text: lines without licence words of about most_docs documents."""
    rows = docs.filter((F.length(f"`{text}`") > 0)).select("doc_id", F.col(f"`{text}`").alias("text"))
    pick = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) + 0.5) / (1 << 30)
    fit = F.filter(F.split("text", "\n"), lambda x: ~x.rlike(LICENCE_WORDS) & (F.length(x) < 2000))
    hashed = F.transform(fit, lambda x: F.struct(F.xxhash64(F.col("doc_id"), x).alias("hash"), x.alias("line")))
    lines = rows.filter(pick < min(1.0, most_docs / max(1, docs.count()))).select(F.explode(F.slice(F.array_sort(hashed), 1, per_doc)).alias("its")).select("its.line")
    others = sorted({r.line.encode() for r in lines.filter(count_words("line") > 0).collect()})
    return Classifier().fit(others)


def scan(docs: DataFrame, classifier: Classifier, *, carry: list[str], into: str = "licenses", text: str = "text") -> DataFrame:
    """The carried columns and a struct: families (distinct, sorted), unknown (number of paragraphs), paragraphs.

    Null and empty texts have none; very long ones are scanned whole, some thousand lines at a time; repeated rows are each scanned; an empty table stays empty; of equal probabilities the
    family first in code-point order is taken; columns that aren't carried play no part.
    """
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    def judge():
        def call(texts: pa.Array) -> pa.Array:
            lines, owner, first = [], [], []
            for i, t in enumerate(texts.cast(pa.binary()).to_pylist()):
                first.append(len(lines))
                its = t.split(b"\n") if t else []
                lines += its
                owner += [i] * len(its)
            out = [{"families": set(), "unknown": 0, "paragraphs": []} for _ in range(len(texts))]
            for line, family, predicted, probability, template in sent.value.scan(lines, owner):
                row = out[owner[line]]
                row["paragraphs"].append({"line": line - first[owner[line]], "family": family, "predicted": predicted, "probability": probability, "template": template})
                if family == UNKNOWN:
                    row["unknown"] += 1
                else:
                    row["families"].add(family)
            for row in out:
                row["families"] = sorted(row["families"])
            return pa.array(out, kind)

        return call

    kind = pa.struct(
        [
            ("families", pa.list_(pa.string())),
            ("unknown", pa.int64()),
            ("paragraphs", pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("predicted", pa.string()), ("probability", pa.float64()), ("template", pa.float64())]))),
        ]
    )
    return annotate(docs, text, carry, into, RESULT, judge, 1 << 20)


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, families, unknown and paragraphs of every document."""
    return scan(docs, train(docs), carry=["doc_id"], into="l").select("doc_id", "l.*")
