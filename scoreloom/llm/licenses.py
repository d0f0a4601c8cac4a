"""License scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory that has a licence.

1. Document frequencies of all terms are counted over all texts, in one aggregate that is written as a table. The tasks
   get those of the templates' terms and of the most frequent ones; any other term weighs at least as much as the most
   frequent term left out.
2. Every window of a text that is as long as a template is compared with it by the cosine of their TF-IDF vectors.
   Running sums of squared weights bound the cosine of each window from above, so only windows that can reach the
   threshold are looked at one by one. Where such a window holds terms whose weight the task does not know, and might be
   the text's best, a join with the table of frequencies gives them. The best window names the text's own licence.
3. A text that is mostly licence, or has the name of a licence file, is its directory's licence file. A text without a
   licence of its own takes that of its nearest ancestor directory: distinct directories are joined on their ancestors
   at the depths at which licence files exist, and the deepest match wins.

Terms are runs of letters and digits, A-Z lower-cased. Of equal cosines the first window and the first template by name
win; of several licence files in a directory the one with the highest cosine, then the smallest path. Null and empty
texts have no licence of their own; a null path lies in no directory and inherits nothing. Repeated rows are one result
each. An empty table gives an empty result. Columns beside those named are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from scoreloom.llm.licence_texts import TELLING, TEMPLATES
from scoreloom.llm.words import FOLDED, map_texts, parts, run_hashes, runs
from scoreloom.session import written

KNOWN_TERMS = 65_536  # some one megabyte in each task
FILE_NAME = r"(?i)^(licen[cs]e|copying|notice)([.\-_].*)?$"
GAP = np.ones(256, bool)
GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def terms(text: str) -> list[int]:
    """The term hashes of a text."""
    data = np.frombuffer(text.encode(), np.uint8)
    start, end = runs(data, np.array([0, len(data)]), GAP)
    return run_hashes(data, start, end, FOLDED).tolist()


def term_counts(texts: DataFrame) -> tuple[DataFrame, int]:
    """In how many texts each term stands, as a written table of ``term`` (its hash) and ``n``; the number of texts."""

    def count(batches):
        rows = 0
        for batch in batches:
            for i, j, data, bounds in parts(batch.column(0)):
                start, end = runs(data, bounds, GAP)
                hashes = run_hashes(data, start, end, FOLDED)
                owner = np.searchsorted(bounds, start, "right")
                order = np.lexsort((owner, hashes))
                hashes, owner = hashes[order], owner[order]
                first = np.ones(len(hashes), bool)  # of each term in each text
                first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                term, held = np.unique(hashes[first], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(held)], names=["term", "n"])
                rows += j - i
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([rows], pa.int64())], names=["term", "n"])

    counts = texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    table = written(counts, "term_counts")
    total = table.where("term IS NULL").first()  # the number of texts
    return table.where("term IS NOT NULL"), total["n"] if total else 0


def frequent_terms(counts: DataFrame, most: int) -> tuple[dict[int, int], int]:
    """The counts of at most about ``most`` terms, the frequent ones, and the largest count of the others."""
    size = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("terms"), F.max("n").alias("n")).collect()
    held, least, rest = 0, None, 0  # some hundred sizes, whatever the number of terms
    for r in sorted(sizes, key=lambda r: -r["size"]):
        held += r["terms"]
        if held > most:
            rest = r["n"]
            break
        least = r["size"]
    if least is None:
        return {}, rest
    return {r["term"] % (1 << 64): r["n"] for r in counts.where(size >= least).collect()}, rest


class Weights:
    """Inverse document frequencies of the known terms and the templates' vectors; the size of the templates.

    ``rest`` is the largest frequency that a term outside ``frequency`` may have, or, if ``settled``, the one it is
    taken to have.
    """

    def __init__(
        self, templates: Mapping[str, list[str]], frequency: dict[int, int], rest: int, texts: int, settled: bool = False,
        telling: Mapping[str, tuple] = TELLING,
    ):
        self.settled = settled
        weigh = lambda n: log((1 + texts) / (1 + n)) + 1
        self.least_other = weigh(rest)
        self.known = np.array(sorted(frequency), np.uint64)
        self.idf = np.array([weigh(frequency[int(t)]) for t in self.known])
        vocabulary = sorted({t for name in templates for text in templates[name] for t in terms(text)})
        place = {t: k for k, t in enumerate(vocabulary)}
        #: The place of each known term in the templates' vocabulary; the last one for all others.
        self.place = np.array([place.get(int(t), len(place)) for t in self.known], np.int32)
        idf = np.array([weigh(frequency[t]) for t in vocabulary])
        self.names, self.lengths, self.products, self.norms, self.telling = [], [], [], [], []
        squares = []
        for name in sorted(templates):
            for text in templates[name]:
                found = terms(text)
                tf = Counter(found)
                vector = np.array([tf.get(t, 0) for t in vocabulary]) * idf
                self.names.append(name)
                self.lengths.append(len(found))
                self.products.append(np.append(idf * vector, 0.0))
                self.norms.append(sqrt(float((vector**2).sum())))
                squares.append(np.append(vector**2, 0.0))
                must, barred, beyond, before = (*telling.get(name, ("", "", 0)), "")[:4]
                groups = [[h for x in group.split("|") for h in terms(x)] for group in must.split()]
                self.telling.append((groups, terms(barred.replace("|", " ")), beyond, terms(before)))
        self.squares = np.array(squares)


def best_windows(weights: Weights, least: float):
    """For ``map_texts``: the best template of each text among the windows whose terms are all known, its cosine, the
    number of the text's terms, and the windows with other terms that may be better."""

    def of(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        start, end = runs(data, bounds, GAP)
        hashes = run_hashes(data, start, end, FOLDED)
        ends = np.searchsorted(start, bounds)
        owner = np.searchsorted(bounds, start, "right") - 1
        at = np.minimum(np.searchsorted(weights.known, hashes), len(weights.known) - 1)
        inside = weights.known[at] == hashes
        idf = np.where(inside, weights.idf[at], weights.least_other)
        place = np.where(inside, weights.place[at], len(weights.products[0]) - 1)
        square = np.concatenate([[0], np.cumsum(idf**2)])
        able: dict[int, list[tuple[float, int, int]]] = {}
        present = np.zeros(len(weights.products[0]))
        present[place] = 1.0
        possible = np.sqrt(weights.squares @ present) >= (least - 1e-6) * np.array(weights.norms)
        stands: dict[int, np.ndarray] = {}  # where a telling term stands

        def holds(term: int, low: int, high: int) -> bool:
            if term not in stands:
                stands[term] = np.flatnonzero(hashes == np.uint64(term))
            k = np.searchsorted(stands[term], low)
            return bool(k < len(stands[term]) and stands[term][k] < high)

        def tells(template: int, i: int, row: int) -> bool:
            groups, barred, beyond, before = weights.telling[template]
            low, high = max(i - 40, int(ends[row])), min(i + weights.lengths[template] + beyond, int(ends[row + 1]))
            listed = any(holds(t, i, high) for t in barred) or any(holds(t, low, i) for t in before)
            return not listed and all(any(holds(t, i, high) for t in g) for g in groups)

        for template, length in enumerate(weights.lengths):
            n = len(hashes) - length + 1
            if n <= 0 or not possible[template]:
                continue
            dot = np.concatenate([[0], np.cumsum(weights.products[template][place])])
            most = (dot[length:] - dot[:n]) / np.sqrt(np.maximum(square[length:] - square[:n], 1e-9))
            most /= weights.norms[template]
            for i in np.flatnonzero((most >= least - 1e-6) & (owner[:n] == owner[length - 1 :])).tolist():
                able.setdefault(int(owner[i]), []).append((-float(most[i]), template, i))
        rows = range(len(bounds) - 1)
        best: list[tuple | None] = [None] * len(rows)
        others: list[list[dict]] = [[] for _ in rows]
        for row, found in able.items():
            highest = least
            for most, template, i in sorted(found):
                if -most < highest - 1e-6:  # nor can the windows after it be better
                    break
                if not tells(template, i, row):
                    continue
                length = weights.lengths[template]
                window = slice(i, i + length)
                term, first, tf = np.unique(hashes[window], return_index=True, return_counts=True)
                first = first + i
                seen = inside[first] | weights.settled
                dot = float((tf * weights.products[template][place[first]]).sum())
                known = float(((tf * idf[first])[seen] ** 2).sum())
                floor = float(((tf * idf[first])[~seen] ** 2).sum())
                cosine = dot / (sqrt(known + floor) * weights.norms[template])
                spot = i - int(ends[row])
                if not seen.all():
                    if cosine >= highest - 1e-9:
                        others[row].append({
                            "template": template, "spot": spot, "dot": dot / weights.norms[template], "known": known, "most": cosine,
                            "terms": [{"term": int(t), "tf": int(k)} for t, k in zip(term[~seen].view(np.int64), tf[~seen])],
                        })
                elif cosine >= least:
                    mine = (-cosine, template, spot)
                    if best[row] is None or cosine > -best[row][0] + 1e-12:
                        best[row] = mine
                    elif abs(cosine + best[row][0]) <= 1e-12:
                        best[row] = min(best[row], mine, key=lambda b: b[1:])
                    highest = max(highest, cosine)
            others[row] = [w for w in others[row] if w["most"] >= highest - 1e-9]
        return [
            pa.array([b and b[1] for b in best], pa.int32()),
            pa.array([b and b[2] for b in best], pa.int32()),
            pa.array([b and -b[0] for b in best], pa.float64()),
            pa.array(np.diff(ends), pa.int32()),
            pa.array(others, WINDOWS),
        ]

    return of


WINDOWS = pa.list_(pa.struct([
    ("template", pa.int32()), ("spot", pa.int32()), ("dot", pa.float64()), ("known", pa.float64()), ("most", pa.float64()),
    ("terms", pa.list_(pa.struct([("term", pa.int64()), ("tf", pa.int32())]))),
]))
FIELDS = [
    T.StructField("template", T.IntegerType()),
    T.StructField("spot", T.IntegerType()),
    T.StructField("cosine", T.DoubleType()),
    T.StructField("n_terms", T.IntegerType()),
    T.StructField("others", from_arrow_type(WINDOWS)),
]


def weighed(found: DataFrame, counts: DataFrame, texts: int, least: float) -> DataFrame:
    """``found`` with the best of all windows in ``m``: real weights for the terms that the tasks did not know."""
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "windows")
    open_rows = found.where(F.size("m.others") > 0)
    one = open_rows.select("row", F.explode("m.others").alias("w"))
    terms_of = one.select("row", "w.template", "w.spot", "w.dot", "w.known", F.explode("w.terms").alias("t"))
    weight = F.log((F.lit(1.0) + texts) / (1 + F.coalesce("n", F.lit(1)))) + 1
    cosines = (
        terms_of.withColumn("term", F.col("t.term")).join(counts, "term", "left")
        .groupBy("row", "template", "spot", "dot", "known").agg(F.sum((F.col("t.tf") * weight) ** 2).alias("other"))
        .select("row", "template", "spot", (F.col("dot") / F.sqrt(F.col("known") + F.col("other"))).alias("cosine"))
    )
    # Cosines that differ by rounding only are equal.
    first = F.struct((-F.round("cosine", 11)).alias("c"), "template", "spot", "cosine")
    best = cosines.where(F.col("cosine") >= least).groupBy("row").agg(F.min(first).alias("b"))
    held = F.when(F.col("m.cosine").isNotNull(), F.struct(
        (-F.round("m.cosine", 11)).alias("c"), F.col("m.template").alias("template"), F.col("m.spot").alias("spot"),
        F.col("m.cosine").alias("cosine"),
    ))
    narrow = lambda b: F.struct(b["template"].alias("template"), b["cosine"].alias("cosine"), F.col("m.n_terms").alias("n_terms"))
    settled = found.where(F.size("m.others") == 0).withColumn("m", F.struct("m.template", "m.cosine", "m.n_terms"))
    chosen = open_rows.join(best, "row", "left").withColumn("m", narrow(F.least(held, F.col("b")))).drop("b")
    return settled.unionByName(chosen)


def scan(
    docs: DataFrame,
    path: Column,
    key: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, list[str]] = TEMPLATES,
    least: float = 0.8,
    file_share: float = 0.5,
    all_terms: bool = False,
    known_terms: int = KNOWN_TERMS,
    telling: Mapping[str, tuple] = TELLING,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, path, own licence and cosine, whether it is a licence file, the licence
    that holds and the directory it comes from (null: its own, or none).

    ``all_terms``: weigh every term by its own document frequency; otherwise terms that stand in no template weigh as
    one seen in one text, however common they are, and a notice with an ordinary extra word is lost in a large table.
    ``known_terms``: how many frequent terms the tasks know the weight of; it changes the time only.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), path.alias("path"), F.col(f"`{text}`").alias("text"))
    counts, texts = term_counts(rows.select("text"))
    frequent, rest = frequent_terms(counts, known_terms) if all_terms else ({}, 1)
    vocabulary = {t for given in templates.values() for x in given for t in terms(x)}
    signed = [t - (1 << 64) if t >= 1 << 63 else t for t in vocabulary]
    own = {r["term"] % (1 << 64): r["n"] for r in counts.where(F.col("term").isin(signed)).collect()}
    weights = Weights(templates, dict.fromkeys(vocabulary, 0) | frequent | own, rest, texts, not all_terms, telling)
    found = map_texts(rows, best_windows(weights, least), FIELDS, carry=["id", "path"], out="m")
    found = weighed(found, counts, texts, least)
    given = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(k).alias("terms")) for n, k in zip(weights.names, weights.lengths)))
    template = F.when(F.col("m.template").isNotNull(), F.element_at(given, F.col("m.template") + 1))
    share = F.try_divide(template["terms"], F.col("m.n_terms"))
    found = found.withColumn("m", F.struct(template["name"].alias("licence"), "m.cosine", share.alias("share")))
    name, folder = F.regexp_extract("path", r"([^/]*)$", 1), F.regexp_replace("path", r"/?[^/]*$", "")
    is_file = F.col("m.licence").isNotNull() & ((F.col("m.share") >= file_share) | name.rlike(FILE_NAME))
    files = written(
        found.select(
            "id", "path", "m.licence", "m.cosine", F.coalesce(is_file, F.lit(False)).alias("licence_file"), folder.alias("folder")
        ),
        "licences",
    )

    of_folder = (
        files.where("licence_file AND folder IS NOT NULL").groupBy("folder")
        .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "path", "licence"))["licence"].alias("given"))
        .select(F.col("folder").alias("ancestor"), "given")
    )
    depth = F.when(F.col("ancestor") == "", 0).otherwise(F.size(F.split("ancestor", "/")))
    of_folder = written(of_folder.withColumn("depth", depth), "folder_licences")
    depths = F.array(*(F.lit(r[0]) for r in of_folder.select("depth").distinct().orderBy("depth").collect())).cast("array<int>")
    own_depth = F.when(F.col("folder") == "", 0).otherwise(F.size(F.split("folder", "/")))
    needy = files.where("licence IS NULL AND folder IS NOT NULL").select("folder").distinct().withColumn("own_depth", own_depth)
    tried = needy.withColumn("depth", F.explode(F.filter(depths, lambda d: d <= F.col("own_depth"))))
    tried = tried.withColumn("ancestor", F.expr("substring_index(folder, '/', depth)"))
    nearest = (
        tried.join(of_folder, ["ancestor", "depth"])
        .groupBy("folder").agg(F.max(F.struct("depth", "ancestor", "given")).alias("from"))
        .select("folder", F.col("from.ancestor").alias("inherited_from"), F.col("from.given").alias("inherited"))
    )
    needs = F.when(F.col("licence").isNull(), F.col("folder"))
    return (
        files.withColumn("needs", needs)
        .join(nearest.withColumnRenamed("folder", "needs"), "needs", "left")
        .select(
            F.col("id").alias(key), "path", F.col("licence").alias("own_licence"), "cosine", "licence_file",
            F.coalesce("licence", "inherited").alias("licence"), "inherited_from",
        )
    )
