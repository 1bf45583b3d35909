"""TF-IDF weights and cosine top-k over sparse rows (unit, token, weight).

A *unit* is whatever the caller ranks: a document or a chunk, identified by one or more columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.arrays import run_lengths, run_starts
from lectern.functions.text import tokens
from lectern.operators.ordering import dense_index
from lectern.operators.rows import BROADCAST_BYTES, BROADCAST_ROWS, explode_structs, fits, sized, top_k
from lectern.session import stage

# Longest token that is broadcast, in bytes: text without breaks may be one token of any length.
TOKEN_BYTES = 64

# Similarities that agree to this many digits are ties: their last digits depend on the order in
# which the parts are added.
TIE_DIGITS = 9


def term_frequency(units: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, token, count, total_tokens) rows.

    Terms are counted within the row, from the sorted token array, so nothing is shuffled.
    """
    return _terms(counted_terms(units, keys, text), keys)


def counted_terms(units: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, total_tokens, terms): one row per unit with its distinct tokens and their counts."""
    listed = units.select(*keys, F.sort_array(tokens(text)).alias("_tokens"))
    cut = listed.select(*keys, "_tokens", run_starts(F.col("_tokens")).alias("_starts"))
    return cut.select(
        *keys,
        F.size("_tokens").alias("total_tokens"),
        run_lengths(F.col("_tokens"), F.col("_starts"), "token", "count").alias("terms"),
    )


def _terms(counted: DataFrame, keys: list[str]) -> DataFrame:
    return explode_structs(counted, [*keys, "total_tokens"], F.col("terms"), ["token", "count"])


def document_frequency(units: DataFrame, text: str = "text") -> DataFrame:
    """(token, df): the number of units that hold the token; summed within each task first."""
    return _counts(units, text).where("token IS NOT NULL")


def _counts(units: DataFrame, text: str) -> DataFrame:
    """(token, df), where the null token stands for the unit itself: its df is the number of units."""
    listed = F.array_append(F.array_distinct(tokens(text)), F.lit(None))
    return units.select(F.explode_outer(listed).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def inverse_document_frequency(units: DataFrame, text: str = "text") -> DataFrame:
    """(token, df, idf) with idf = ln(N / (df + 1)): 0 for a token in all but one unit, negative in all.

    One pass over the corpus counts tokens and units alike; the counts are staged, so whatever
    follows reads a narrow table of known size.
    """
    return _idf(stage(_counts(units, text), "df"))


def token_counts(units: DataFrame, text: str = "text") -> DataFrame:
    """(token, df) of a fit as a table to be stored and kept up to date; the null token's df is the number of
    units. ``fitted`` makes weights of it, ``merged_counts`` adds a delivery."""
    return _counts(units, text)


def merged_counts(counts: DataFrame, arriving: DataFrame, leaving: DataFrame, text: str = "text") -> DataFrame:
    """The counts after a delivery: those of ``arriving`` units are added, those of ``leaving`` ones taken away, and
    tokens that no unit holds any more are dropped. Changed units leave with their old text and arrive
    with the new one. Only the delivery is read, and the result is that of a new fit.
    """
    less = _counts(leaving, text).withColumn("df", -F.col("df"))
    signed = counts.select("token", "df").unionByName(_counts(arriving, text)).unionByName(less)
    summed = signed.groupBy("token").agg(F.sum("df").alias("df"))
    if summed.where("df < 0").take(1):
        raise ValueError("units leave that the counts do not hold")
    return summed.where("df > 0")


def fitted(counts: DataFrame) -> DataFrame:
    """(token, df, idf) from stored counts; no rows of counts give none."""
    return _idf(counts)


def _unit_counts(counted: DataFrame) -> DataFrame:
    """As ``_counts``, from counted terms."""
    listed = F.array_append(F.col("terms.token"), F.lit(None))
    return counted.select(F.explode_outer(listed).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def _idf(counts: DataFrame) -> DataFrame:
    total = counts.where("token IS NULL").select("df").scalar()
    known = counts.where("token IS NOT NULL")
    return known.select("token", "df", F.log(total / (F.col("df") + 1)).alias("idf"))


def vocabulary(units: DataFrame, text: str = "text") -> DataFrame:
    """(token, token_index): all distinct tokens, numbered in code-point order."""
    return dense_index(document_frequency(units, text).select("token"), "token", "token_index", "vocabulary")


def split_vocabulary(
    idf: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame | None]:
    """(frequent, rare): all tokens, if they are within ``rows`` and ``size`` bytes; else the most frequent ones, at
    most ``rows`` of them and none of more than ``TOKEN_BYTES`` bytes, and the others. So what is broadcast
    is bounded in bytes as well.

    The border is a power of two, found in a histogram of at most 64 rows.
    Most rows of a corpus belong to frequent tokens; broadcasting those keeps the rows in place, and
    what remains to be shuffled is few rows, none of whose tokens holds more than ``2 / rows`` of all
    rows, so that no token can crowd a task.
    """
    length = F.octet_length("token")
    short = length <= TOKEN_BYTES
    bits = F.length(F.bin("df")).alias("bits")
    histogram = idf.groupBy(bits).agg(F.count("*").alias("all"), F.count_if(short).alias("short"), F.sum(length + 16).alias("bytes")).collect()
    if sum(r["all"] for r in histogram) <= rows and sum(r["bytes"] for r in histogram) <= size:
        return F.broadcast(idf), None
    counted, border = 0, 0
    for row in sorted(histogram, key=lambda r: -r["bits"]):
        counted += row["short"]
        if counted > rows:
            border = 1 << row["bits"]
            break
    frequent = short & (F.col("df") >= border)
    return F.broadcast(idf.where(frequent)), idf.where(~frequent)


def _weight() -> Column:
    return F.col("count") / F.col("total_tokens") * F.col("idf")


def weights(
    terms: DataFrame, idf: DataFrame, keys: list[str], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(keys, token, weight): share of the unit's tokens times idf.

    Tokens without an idf are dropped but still count in the unit's total.
    """
    frequent, rare = split_vocabulary(idf, broadcast_rows)
    weighted = terms.join(frequent, "token")
    if rare is not None:
        rest = terms.join(F.broadcast(frequent.select("token")), "token", "left_anti")
        weighted = weighted.unionByName(rest.join(rare, "token"))
    return weighted.select(*keys, "token", _weight().alias("weight"))


@dataclass(frozen=True)
class TfidfIndex:
    """Weights of a corpus: the idf table and one stored row per unit with its vector and norm."""

    idf: DataFrame
    vectors: DataFrame
    keys: list[str]


def vectors(
    units: DataFrame,
    idf: DataFrame,
    keys: list[str],
    text: str = "text",
    *,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """As ``counted_vectors``, from texts."""
    return counted_vectors(counted_terms(units, keys, text), idf, keys, broadcast_rows=broadcast_rows)


def counted_vectors(
    counted: DataFrame, idf: DataFrame, keys: list[str], *, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(keys, terms, norm): one sparse vector per unit with its Euclidean norm.

    A unit without any known token has no row; its similarity to everything is 0.

    The terms of a unit stand in one row, so with a vocabulary within the bound nothing but the keys is
    shuffled. Beyond it, its rare tokens are looked up by a shuffle join on their own, and a row per unit of
    them meets the vector of the others.
    """

    if fits(idf, broadcast_rows):
        return _vectors_in_place(counted, idf, keys)
    frequent, rare = split_vocabulary(idf, broadcast_rows)
    whole = _vectors_in_place(counted, frequent, keys)
    if rare is None:
        return whole
    rest = _terms(counted, keys).join(F.broadcast(frequent.select("token")), "token", "left_anti").join(rare, "token")
    rest = rest.dropna(subset=keys).withColumn("weight", _weight())
    found = rest.groupBy(*keys).agg(
        F.sum(F.col("weight") * F.col("weight")).alias("_square"),
        F.collect_list(F.struct("token", "weight")).alias("_rest"),
    )
    none = F.array().cast(whole.schema["terms"].dataType)
    square = F.coalesce(F.col("norm") * F.col("norm"), F.lit(0.0)) + F.coalesce("_square", F.lit(0.0))
    return whole.join(found, keys, "full").select(
        *keys,
        F.concat(F.coalesce("terms", none), F.coalesce("_rest", none)).alias("terms"),
        F.sqrt(square).alias("norm"),
    )


def _vectors_in_place(counted: DataFrame, idf: DataFrame, keys: list[str], add: bool = False) -> DataFrame:
    """As ``counted_vectors``, of the tokens of an idf table within the bound: it goes to every task, and a unit's row of terms
    becomes its vector where it lies. Rows that share their keys are one unit, so theirs are put together; with
    ``add``, for keys that are not null, a token that several of them hold has one weight, the sum."""
    table = idf.select("token", "idf").toArrow()  # within the bound, as its caller has checked
    sent = counted.sparkSession.sparkContext.broadcast(table)
    kinds = {f.name: f.dataType.simpleString() for f in counted.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", terms array<struct<token:string,weight:double>>, norm double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tokens, idfs = sent.value.column("token").combine_chunks(), sent.value.column("idf").to_numpy()
        for batch in batches:
            lists, total = batch.column(len(keys) + 1), batch.column(len(keys)).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            token = pc.index_in(flat.field("token"), tokens)
            hit = np.flatnonzero(token.is_valid().to_numpy(zero_copy_only=False))
            if not len(hit):
                continue
            row, at = row[hit], token.take(pa.array(hit)).to_numpy(zero_copy_only=False)
            weight = flat.field("count").to_numpy(zero_copy_only=False)[hit] / total[row] * idfs[at]
            found, starts = np.unique(row, return_index=True)
            norm = np.sqrt(np.add.reduceat(weight * weight, starts))
            terms = pa.StructArray.from_arrays([flat.field("token").take(pa.array(hit)), pa.array(weight)], names=["token", "weight"])
            offsets = pa.array(np.r_[starts, len(row)].astype(np.int32))
            columns = [batch.column(i).take(pa.array(found)) for i in range(len(keys))]
            columns += [pa.ListArray.from_arrays(offsets, terms), pa.array(norm)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "terms", "norm"])

    def weighed(rows: DataFrame) -> DataFrame:
        return rows.select(*keys, "total_tokens", "terms").mapInArrow(run, schema)

    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    repeated = counted.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    repeated = stage(repeated.select(*[F.col(key).alias(f"_{key}") for key in keys]), "repeated")
    if not repeated.take(1):
        return weighed(counted)
    several = sized(repeated)
    parts = weighed(counted.join(several, same, "left_semi"))
    norm = F.sqrt(F.sum(F.col("norm") * F.col("norm"))).alias("norm")
    together = parts.groupBy(*keys).agg(F.flatten(F.collect_list("terms")).alias("terms"), norm)
    if add:
        single = explode_structs(parts, keys, F.col("terms"), ["token", "weight"]).groupBy(*keys, "token").agg(F.sum("weight").alias("weight"))
        summed = single.groupBy(*keys).agg(F.collect_list(F.struct("token", "weight")).alias("terms"))
        together = summed.join(together.select(*keys, "norm"), keys).select(*keys, "terms", "norm")
    return weighed(counted.join(several, same, "left_anti")).unionByName(together)


def norms(counted: DataFrame, idf: DataFrame, keys: list[str], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(keys, norm) of units with counted terms. Squares are summed within the task that holds the unit;
    only rare tokens beyond the broadcast bound are looked up by a shuffle join."""
    frequent, rare = split_vocabulary(idf, broadcast_rows)
    square = (_weight() * _weight()).alias("_square")
    squares = _terms(counted, keys).join(frequent, "token").select(*keys, square)
    if rare is not None:
        rest = _terms(counted, keys).join(F.broadcast(frequent.select("token")), "token", "left_anti")
        squares = squares.unionByName(rest.join(rare, "token").select(*keys, square))
    return squares.groupBy(*keys).agg(F.sqrt(F.sum("_square")).alias("norm"))


def build_index(units: DataFrame, keys: list[str], text: str = "text") -> TfidfIndex:
    """Fit a corpus and store its vectors, so that later query batches only scan them."""
    idf = inverse_document_frequency(units, text)
    return TfidfIndex(idf, stage(vectors(units, idf, keys, text), "tfidf"), keys)


def _query_weights(queries: DataFrame, idf: DataFrame) -> DataFrame:
    """Staged (query_id, token, query_weight, idf, query_norm) of the query texts; of the idf table only the
    tokens that some query holds are looked at."""
    terms = stage(term_frequency(queries, ["query_id"], "query_text"), "query-terms")
    needed = idf.join(sized(terms.select("token").distinct()), "token", "left_semi")
    weighted = terms.join(needed, "token").withColumn("query_weight", _weight())
    norms = weighted.groupBy("query_id").agg(
        F.sqrt(F.sum(F.col("query_weight") * F.col("query_weight"))).alias("query_norm")
    )
    kept = weighted.select("query_id", "token", "query_weight", "idf")
    return stage(kept.join(norms, "query_id"), "query-weights")


def _rank(scored: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k most similar units per query; ties go to the later unit; similarity 0 never counts."""
    positive = scored.where(F.col("similarity") > 0)
    rounded = F.floor(F.col("similarity") * 10**TIE_DIGITS + 0.5)
    order = [rounded.desc(), *[F.col(key).desc() for key in keys]]
    return top_k(positive, "query_id", order, k)


def search_index(index: TfidfIndex, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, keys, similarity, rank) against a stored index.

    If the counted terms of the queries are within the bound, they go to every task, and the units are
    scored where they lie: one scan, and only k rows per query and task are shuffled (see ``_best_in_place``).
    Beyond it, terms meet query terms in a join, and the products of a unit and query are summed by a shuffle.
    """
    query_terms = _query_weights(queries, index.idf)
    if fits(query_terms):
        found = _best_in_place(index.vectors, query_terms, index.keys, k)
    else:
        found = _similarity(index.vectors, query_terms, index.keys)
    return _rank(found, index.keys, k)


def _similarity(vectors: DataFrame, query_terms: DataFrame, keys: list[str]) -> DataFrame:
    hits = explode_structs(vectors, [*keys, "norm"], F.col("terms"), ["token", "weight"])
    matched = hits.join(query_terms, "token")
    dots = matched.groupBy(*keys, "query_id").agg(
        F.sum(F.col("weight") * F.col("query_weight")).alias("dot"),
        F.first("norm").alias("norm"),
        F.first("query_norm").alias("query_norm"),
    )
    return dots.select(*keys, "query_id", _cosine().alias("similarity"))


def _cosine() -> Column:
    cosine = F.try_divide(F.col("dot"), F.col("norm") * F.col("query_norm"))
    return F.coalesce(cosine, F.lit(0.0))


# Units of the first block of a task and of the largest one, and pairs scored at a time.
FIRST_BLOCK, LARGEST_BLOCK = 32, 4096
_PAIRS = 1 << 18


class QueryTerms:
    """The terms of some queries by token, and each query's k best similarities of a task so far."""

    def __init__(self, queries, tokens, shares, k: int):
        """``shares``: the terms' weights over the norm of their query."""
        import numpy as np

        self.names, query = np.unique(queries, return_inverse=True)
        self.tokens, token = np.unique(tokens, return_inverse=True)
        order = np.lexsort((token, query))
        self.query, self.token, self.share = query[order], token[order], np.asarray(shares, np.float64)[order]
        self.starts = np.searchsorted(self.query, np.arange(len(self.names) + 1))
        self.k = k
        self.best = np.zeros((len(self.names), k))
        self.pairs = 0  # how many (unit, query) pairs were scored

    def essential(self, largest):
        """Which terms can bring a unit of a block among its query's best, given the largest weight of each
        token in the block: all but those whose largest products sum to less than the k-th similarity."""
        import numpy as np

        product = np.abs(self.share) * largest[self.token]  # both have the sign of the token's idf
        order = np.lexsort((product, self.query))
        total = np.cumsum(product[order])
        before = np.r_[0.0, total][self.starts[:-1]]
        upto = total - before[self.query[order]]
        kth = self.best[:, 0][self.query[order]]
        out = np.zeros(len(product), bool)
        out[order] = upto >= kth * (1 - 1e-6) - 1e-12
        return out & (product > 0)

    def score(self, rows, tokens, weights):
        """(unit's row, query, similarity) of the pairs of a block that may be among their query's best.
        ``rows``, ``tokens`` and ``weights`` (over the unit's norm): the units' terms that some query holds."""
        import numpy as np

        by_token = np.argsort(tokens, kind="stable")
        places = np.searchsorted(tokens[by_token], np.arange(len(self.tokens) + 1))
        largest = np.zeros(len(self.tokens))
        np.maximum.at(largest, tokens, np.abs(weights))
        used = np.flatnonzero(self.essential(largest))
        begins, counts = places[self.token[used]], np.diff(places)[self.token[used]]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        met = rows[by_token[np.repeat(begins, counts) + within]] * len(self.names) + np.repeat(self.query[used], counts)
        pairs = np.unique(met)
        key = rows * len(self.tokens) + tokens
        order = np.argsort(key)
        key, weights = key[order], weights[order]
        found = []
        step = max(1, _PAIRS // int(np.diff(self.starts).max(initial=1)))
        for a in range(0, len(pairs), step):
            row, query = np.divmod(pairs[a : a + step], len(self.names))
            sizes = self.starts[query + 1] - self.starts[query]
            pair = np.repeat(np.arange(len(row)), sizes)
            term = np.repeat(self.starts[query], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            wanted = row[pair] * len(self.tokens) + self.token[term]
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            product = np.where(key[at] == wanted, weights[at] * self.share[term], 0.0)
            found.append((row, query, np.bincount(pair, product, len(row))))
        self.pairs += len(pairs)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        row, query, similarity = (np.concatenate(c) for c in zip(*found, strict=True))
        rounded = np.floor(similarity * 10**TIE_DIGITS + 0.5) / 10**TIE_DIGITS
        return self._keep(row, query, similarity, rounded)

    def _keep(self, row, query, similarity, rounded):
        """Pairs above zero that are not below their query's k-th similarity, ties included; that is moved up."""
        import numpy as np

        use = (similarity > 0) & (rounded >= self.best[query, 0] - 0.5 / 10**TIE_DIGITS)
        row, query, similarity, rounded = row[use], query[use], similarity[use], rounded[use]
        order = np.lexsort((-rounded, query))
        first = np.searchsorted(query[order], np.arange(len(self.names)))
        place = np.arange(len(order)) - first[query[order]]
        top = order[place < self.k]
        for q in np.unique(query[top]).tolist():
            self.best[q] = np.sort(np.r_[self.best[q], rounded[top[query[top] == q]]])[-self.k :]
        use = rounded >= self.best[query, 0] - 0.5 / 10**TIE_DIGITS
        return row[use], query[use], similarity[use]


def _best_in_place(vectors: DataFrame, query_terms: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys, query_id, similarity) of every task's units that may be among a query's k best.

    A task goes through its units in blocks, small ones first. Of a block it knows the largest weight of every
    token, and so which terms of a query can lift a unit above the k-th similarity found so far; only
    units that hold such a term are scored for the query. Common words are such terms hardly ever, so
    that few of all pairs are looked at. The products of a unit are summed where it lies.
    """
    rows = query_terms.select("query_id", "token", F.try_divide("query_weight", "query_norm").alias("share"))
    table = rows.where("share IS NOT NULL").toPandas()  # within the bound, as its caller has checked
    sent = vectors.sparkSession.sparkContext.broadcast(table)
    kinds = {f.name: f.dataType.simpleString() for f in [*vectors.schema, *query_terms.schema]}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, "query_id"]) + ", similarity double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        asked = sent.value
        if asked.empty:
            return
        names = asked["query_id"].drop_duplicates().sort_values().to_numpy()
        number = np.searchsorted(names, asked["query_id"].to_numpy())
        terms = QueryTerms(number, asked["token"].to_numpy(str), asked["share"].to_numpy(), k)
        wanted = pa.array(terms.tokens.tolist(), pa.string())
        held: list[pa.Table] = []

        def best_so_far() -> list[pa.Table]:
            """Of what is held, each query's k best, ties by the later unit."""
            found = pa.concat_tables(held)
            rounded = np.floor(found.column("similarity").to_numpy() * 10**TIE_DIGITS + 0.5)
            order = found.select([*keys, "query_id"]).append_column("_by", pa.array(rounded))
            sorting = [("query_id", "ascending"), ("_by", "descending"), *((c, "descending") for c in keys)]
            place = pc.sort_indices(order, sort_keys=sorting)
            found = found.take(place)
            query = found.column("query_id").to_numpy()
            return [found.filter(pa.array(np.arange(len(query)) - np.searchsorted(query, query) < k))]

        size = FIRST_BLOCK
        for batch in batches:
            a = 0
            while a < batch.num_rows:
                block = batch.slice(a, size)
                a, size = a + size, min(size * 2, LARGEST_BLOCK)
                lists, norm = block.column(len(keys)), block.column(len(keys) + 1).to_numpy(zero_copy_only=False)
                flat = lists.flatten()
                row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                token = pc.index_in(flat.field(0), wanted)
                hit = np.flatnonzero(token.is_valid().to_numpy(zero_copy_only=False))
                row, weight = row[hit], flat.field(1).to_numpy(zero_copy_only=False)[hit]
                use = norm[row] > 0
                if not use.any():
                    continue
                row, weight = row[use], weight[use] / norm[row[use]]
                token = token.take(pa.array(hit[use])).to_numpy(zero_copy_only=False).astype(np.int64)
                at, query, similarity = terms.score(row, token, weight)
                if len(at):
                    columns = [block.column(i).take(pa.array(at)) for i in range(len(keys))]
                    columns += [pa.array(names[terms.names[query]]), pa.array(similarity)]
                    held.append(pa.table(columns, names=[*keys, "query_id", "similarity"]))
                    if sum(map(len, held)) > 4 * k * len(names) + LARGEST_BLOCK:
                        held = best_so_far()
        if held:
            yield from best_so_far()[0].combine_chunks().to_batches()

    return vectors.select(*keys, "terms", "norm").mapInArrow(run, schema)


def search(
    units: DataFrame,
    queries: DataFrame,
    keys: list[str],
    k: int = 5,
    text: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(query_id, keys, similarity, rank): the k units most similar to each query text.

    Fits the corpus first. Units are cut and tokenised once: one row per unit with its counted terms is
    stored, and document frequencies, norms and products are taken from there. Where the terms of the queries are
    within the bound, units become vectors and are scored by the task that holds them, and only k rows per query and
    task are shuffled; beyond the bound of the vocabulary, units meet their norms in a join, with those of their
    terms that some query holds. The vectors are not stored, as they serve one batch of queries only;
    ``build_index`` stores them for many.
    """
    counted = stage(counted_terms(units, keys, text), "counted")
    idf = _idf(stage(_unit_counts(counted), "df"))
    query_terms = _query_weights(queries, idf)
    if fits(query_terms):
        known = counted.dropna(subset=keys)  # as in the joins below
        if fits(idf, broadcast_rows):
            found = _vectors_in_place(known, idf, keys, add=True)
        else:
            asked = query_terms.select("token", "idf").distinct()
            found = _vectors_in_place(known, asked, keys, add=True).drop("norm").join(norms(counted, idf, keys, broadcast_rows), keys)
        return _rank(_best_in_place(found, query_terms, keys, k), keys, k)
    matched = _terms(counted, keys).join(sized(query_terms), "token")
    dots = matched.groupBy(*keys, "query_id").agg(
        F.sum(_weight() * F.col("query_weight")).alias("dot"), F.first("query_norm").alias("query_norm")
    )
    scored = dots.join(norms(counted, idf, keys, broadcast_rows), keys)
    return _rank(scored.select(*keys, "query_id", _cosine().alias("similarity")), keys, k)
