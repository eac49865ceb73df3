"""Language-model scores from a hierarchical Pitman-Yor process over the whole vocabulary.

Each token has a restaurant of its own whose customers are the tokens that followed it; all of them share one parent
restaurant, whose customers are the tables of its children and whose base is diffuse: each
token has one table there, and what the base keeps belongs to all unknown tokens together. A Gibbs sweep lets all customers of one dish in one restaurant stand up and seats them
anew, one after the other, by the Chinese-restaurant rule, with everything else as it is; the sampled tables then are the
parent's customers. Predictive probabilities are averaged over the sweeps after burn-in.

A dish with one customer always has one table, so seats are kept for pairs that occur twice or more; with N customers in
a restaurant, its tables are N less the sum of (customers - tables) over those pairs. A training document's pair that is
not among them has one customer. The ``NEAR`` most frequent tokens travel to every task with their probabilities, and so
do at most ``PAIRS`` of the most frequent pairs and a filter of the others, only to save joins; all that they do not settle
is joined.

Pairs of two near tokens, which are most, are dealt out by hash to buckets that hold some ``BUCKET`` training tokens each,
and are exchanged, stored and met as one row of arrays for each bucket. Pairs with another token are rows of their own.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from tallystrata.llm import bloom, text as tx
from tallystrata.sources import files
from tallystrata.sources.scratch import scratch_path, shuffles_let_go, stored

DISCOUNT, STRENGTH = 0.6, 1.0
BURN_IN, SAMPLES, SEED = 2, 4, 17
#: Hash of the end of a text, which no word has but by chance.
END = np.uint64(0x0E0F0E0F0E0F0E0F)
#: Tokens and pairs that travel with the model, so that they need no join. The result does not depend on them.
NEAR, PAIRS = 1 << 20, 1 << 20
#: Tokens whose pairs are counted together within a task.
PIECE = 1 << 21
#: Training tokens for each bucket of pairs, so the number of buckets follows the input.
BUCKET = 1 << 20
#: Near tokens that the driver seats at once, and whose seats are summed together.
SLICE = 1 << 16
_FAR = np.uint64(1 << 63)


class Model(NamedTuple):
    near: np.ndarray    # sorted hashes of the most frequent tokens; the number of a token is its index, of others the negative hash
    count: np.ndarray   # training occurrences of the near tokens
    share: np.ndarray   # [sample, near token] weight of the parent in the token's restaurant
    parent: np.ndarray  # [sample, near token] probability in the parent restaurant
    once: np.ndarray    # [sample] probability in the parent restaurant of a token that occurs once
    unseen: np.ndarray  # [sample] the same of all unknown tokens together
    total: int          # training tokens
    kinds: int


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, the end after each document's words, and where each document begins."""
    w = tx.words(raw, offsets)
    docs = len(offsets) - 1
    first = w.first + np.arange(docs + 1)
    out = np.empty(len(w.hash) + docs, dtype=np.uint64)
    is_end = np.zeros(len(out), dtype=bool)
    is_end[first[1:] - 1] = True
    out[is_end] = END
    out[~is_end] = w.hash
    return out, first


class Pairs(NamedTuple):
    near: DataFrame    # bucket, pair, n, t, kept: the pairs of two near tokens, arrays in the order of pair
    far: DataFrame     # u, w, mass: the others
    buckets: int


def _starts(values: np.ndarray) -> np.ndarray:
    """For each value of the leading bits, where it begins among ``values``: sorted 64-bit hashes."""
    bits = max(len(values), 1).bit_length()
    return np.searchsorted(values, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))


def _places(values: np.ndarray, starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each key in ``values``, any where it is not there, and whether it is."""
    if not len(values):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    last = len(values) - 1
    at = np.minimum(starts[keys >> np.uint64(65 - len(starts).bit_length())], last)
    # Hashes are spread evenly, so few steps lead from the first with the same leading bits to the key.
    go = np.flatnonzero(values[at] < keys)
    while len(go):
        go = go[at[go] < last]
        at[go] += 1
        go = go[values[at[go]] < keys[go]]
    return at, values[at] == keys


def _numbers(near: np.ndarray, tokens: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Each token's index in ``near``, or its hash as a negative number; ``starts`` is that of ``near``."""
    at, known = _places(near, _starts(near) if starts is None else starts, tokens)
    return np.where(known, at, (tokens | _FAR).view(np.int64))


def _hash(pair: np.ndarray) -> np.ndarray:
    """Hash of the number of a near pair; different for different pairs."""
    return tx.mix(pair.view(np.uint64))


def _bucket(hashed: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _flat(table: pa.Table, name: str) -> np.ndarray:
    """All entries of an array column, row by row."""
    return pc.list_flatten(table[name]).to_numpy()


def _by_cut(schema: pa.Schema, at: str, cuts: np.ndarray, **values) -> pa.RecordBatch:
    """A row for each stretch of ``values`` between two ``cuts`` that is not empty; ``at`` names its number. Other columns are null."""
    some = np.flatnonzero(np.diff(cuts))
    bounds = np.append(cuts[some], cuts[-1])
    columns = [
        pa.array(some, type=field.type) if field.name == at
        else tx.lists(values[field.name], bounds, field.type.value_type) if field.name in values
        else pa.nulls(len(some), field.type)
        for field in schema
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _rows_of(batches, *names: str):
    """The arrays of one row after the other, and a function that puts its row together with new arrays."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            yield row, *(pc.list_flatten(row.column(batch.schema.get_field_index(x))).to_numpy(zero_copy_only=False) for x in names)


def _distinct_pairs(u: np.ndarray, w: np.ndarray, group: np.ndarray | None = None):
    """Index of one occurrence of each distinct pair (of each group), and how often it occurs."""
    key = tx.mix(u.view(np.uint64) * np.uint64(tx.BASE) + tx.mix(w.view(np.uint64) + np.uint64(1)))
    if group is not None:
        key = tx.mix(key + tx.mix(group.astype(np.uint64) + np.uint64(1)))
    _, index, n = np.unique(key, return_index=True, return_counts=True)
    return index, n


def _schema(number: str, **columns: pa.DataType) -> tuple[pa.Schema, str]:
    """A number and arrays of these types, for Arrow and for Spark."""
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double", pa.bool_(): "boolean"}
    ddl = ", ".join([f"{number} int", *(f"{x} array<{names[t]}>" for x, t in columns.items())])
    return pa.schema([(number, pa.int32()), *((x, pa.list_(t)) for x, t in columns.items())]), ddl


_LONG, _DOUBLE = pa.int64(), pa.float64()
_COUNTED, _COUNTED_DDL = _schema("bucket", pair=_LONG, n=_LONG, far_u=_LONG, far_w=_LONG, far_n=_LONG)


_TOKENS, _TOKENS_DDL = _schema("bucket", token=_LONG, n=_LONG)


def token_counts(train: DataFrame, text: str) -> DataFrame:
    """``token, n`` over all of ``train``; each task sums its batches first, and its tokens go to buckets as arrays."""
    buckets = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Tokens are hashes in order, so each bucket has a range of them.
    borders = np.array([((k << 64) // buckets) for k in range(buckets)], dtype=np.uint64)

    def count(batches):
        for batch in batches:
            found = [_tokens(raw, offsets)[0] for _, _, raw, offsets in tx.slices(batch.column(0))]
            token, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            cuts = np.append(np.searchsorted(token, borders), len(token))
            yield _by_cut(_TOKENS, "bucket", cuts, token=tx.signed(token), n=n)

    def together(table):
        token, at = np.unique(_flat(table, "token"), return_inverse=True)
        n = np.zeros(len(token), np.int64)
        np.add.at(n, at, _flat(table, "n"))
        return pa.Table.from_arrays([pa.array(token), pa.array(n)], names=["token", "n"])

    return train.select(text).mapInArrow(count, _TOKENS_DDL).groupBy("bucket").applyInArrow(together, "token bigint, n bigint")


def pair_counts(docs: DataFrame, known: Broadcast, buckets: int) -> DataFrame:
    """A row of arrays for each bucket: token w follows token u n times in training; pairs with n = 1 only where a document outside
    has them too.

    ``docs`` has the columns ``_text`` and ``_train``; a text begins after an end. ``known`` are the near tokens: ``pair`` is the
    number of u times their count and the number of w; pairs with another token have both.
    """
    size_of_near = len(known.value)
    span = size_of_near**2

    def piece(found):
        u, w, train = (np.concatenate(x) for x in zip(*found))
        both = (u >= 0) & (w >= 0)
        pair = u[both] * size_of_near + w[both]
        pair += _bucket(_hash(pair), buckets) * span
        for inside in (True, False):
            keys, n = np.unique(pair[train[both] == inside], return_counts=True)
            # Documents outside give n = 0.
            yield _by_cut(
                _COUNTED, "bucket", np.searchsorted(keys, np.arange(buckets + 1) * span), pair=keys % span, n=n if inside else n * 0
            )
        u, w, train = u[~both], w[~both], train[~both]
        index, n = _distinct_pairs(u, w, train)
        at = _bucket(_key(u[index], w[index]), buckets)
        order = np.argsort(at, kind="stable")
        index, n = index[order], n[order]
        yield _by_cut(
            _COUNTED, "bucket", np.searchsorted(at[order], np.arange(buckets + 1)), far_u=u[index], far_w=w[index],
            far_n=np.where(train[index], n, 0),
        )

    def count(batches):
        found, size = [], 0
        near = known.value
        starts = _starts(near)
        end = _numbers(near, np.array([END]), starts)
        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, raw, offsets in tx.slices(batch.column(0)):
                tokens, first = _tokens(raw, offsets)
                s = _numbers(near, tokens, starts)
                found.append((np.concatenate([end, s[:-1]]), s, np.repeat(train[i:j], np.diff(first))))
                size += len(s)
                if size >= PIECE:
                    yield from piece(found)
                    found, size = [], 0
        if found:
            yield from piece(found)

    def summed(n, *sorted_by):
        """Where each pair that stays begins, and its count."""
        if not len(n):
            return np.zeros(0, np.int64), n
        new = np.ones(len(n), bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in sorted_by], axis=0)
        first = np.flatnonzero(new)
        total, least = np.add.reduceat(n, first), np.minimum.reduceat(n, first)
        stays = (total > 1) | ((total == 1) & (least == 0))
        return first[stays], total[stays]

    def together(table):
        pair, n, u, w, far_n = (_flat(table, x) for x in _COUNTED.names[1:])
        order = np.argsort(pair)
        pair = pair[order]
        first, n = summed(n[order], pair)
        order = np.lexsort((w, u))
        u, w = u[order], w[order]
        far, far_n = summed(far_n[order], u, w)
        values = pair[first], n, u[far], w[far], far_n
        return pa.Table.from_arrays([table["bucket"].slice(0, 1), *(tx.lists(x, np.array([0, len(x)])) for x in values)], schema=_COUNTED)

    return docs.select("_text", "_train").mapInArrow(count, _COUNTED_DDL).groupBy("bucket").applyInArrow(together, _COUNTED_DDL)


def _uniform(key: np.ndarray, number: int, step: int) -> np.ndarray:
    salt = np.uint64((SEED * 1_000_003 + number) * 1_000_003 + step)
    return (tx.mix(key + tx.mix(np.array([salt]))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def _binomial(n: np.ndarray, p: np.ndarray, uniform: np.ndarray) -> np.ndarray:
    """Binomial quantiles; from a mean of 50 on by a logistic curve of equal mean and variance."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore", under="ignore"):
        p = np.clip(p, 0.0, 1.0)
        out = np.where(p >= 1, n, 0)
        mean = n * p
        large = (mean >= 50) & (p < 1)
        z = np.log(uniform[large] / (1 - uniform[large])) * np.sqrt(3) / np.pi
        out[large] = np.clip(np.rint(mean[large] + z * np.sqrt(mean[large] * (1 - p[large]))), 0, n[large])
        at = np.flatnonzero((mean > 0) & (mean < 50) & (p < 1))
        mass = np.exp(n[at] * np.log1p(-p[at]))
        left = uniform[at] - mass
        k = 0
        while len(at):
            go = (left >= 0) & (k < n[at])
            at, mass, left = at[go], mass[go], left[go]
            mass = mass * (n[at] - k) / (k + 1) * p[at] / (1 - p[at])
            left = left - mass
            k += 1
            out[at] = k
    return out


def seat(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, strength: float, key: np.ndarray, number: int) -> np.ndarray:
    """Tables after each dish's customers sit down one after the other; ``others``: the restaurant's remaining tables.

    A new table is opened with weight (strength + discount * tables) * parent probability, against customers seated less
    discount for each of the dish's tables. From 16 customers on they come in groups of a sixteenth of those seated,
    for which the weights stay as they are, so the work grows with the logarithm of a count. Draws depend on ``key`` and
    the ``number`` of the sweep alone, so a task that runs again seats them the same way.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    seated = tables.copy()
    open_dishes = np.flatnonzero(customers > seated)
    step = 0
    while len(open_dishes):
        n, t = seated[open_dishes], tables[open_dishes]
        group = np.minimum(np.maximum(n // 16, 1), customers[open_dishes] - n)
        new = (strength + discount * (others[open_dishes] + t)) * parent[open_dishes]
        p, draw = new / (new + n - discount * t), _uniform(key[open_dishes], number, step)
        # Single customers first: every dish has the same number seated until there are 32.
        tables[open_dishes] += draw >= np.exp(np.log1p(-p)) if step < 31 else _binomial(group, p, draw)
        seated[open_dishes] += group
        open_dishes = open_dishes[customers[open_dishes] > seated[open_dishes]]
        step += 1
    return tables


def _seat_roots(customers: np.ndarray, others: np.ndarray, discount: float, strength: float, key: np.ndarray, number: int) -> np.ndarray:
    """``seat`` in the parent restaurant, a slice at a time: it needs a dozen arrays as long as its input."""
    out = np.empty(len(customers), dtype=np.int64)
    for i in range(0, len(customers), SLICE):
        j = min(i + SLICE, len(customers))
        out[i:j] = seat(customers[i:j], others[i:j], np.zeros(j - i), discount, strength, key[i:j], number)
    return out


def _key(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return tx.mix(u.astype(np.int64).view(np.uint64) * np.uint64(tx.BASE) + w.astype(np.int64).view(np.uint64))


def _spread(token: str, *others: str) -> Column:
    """Join key of a token: near ones are dealt out to all partitions by keys that meet nothing."""
    return F.when(F.col(token) < 0, F.col(token)).otherwise(F.xxhash64(token, *others).bitwiseAND(F.lit(2**63 - 1)))


def _merged(batches, rows: int = 1 << 17):
    """Larger batches of the same rows, as each one costs a fixed number of steps."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _far(token: str) -> Column:
    return F.col(token) < 0


_, _BLOCKS_DDL = _schema("bucket", pair=_LONG, n=_LONG, t=_LONG, kept=_LONG)
_GAPS, _GAPS_DDL = _schema("slice", token=_LONG, as_u=_LONG, as_w=_LONG)


def _sweep_near(blocks: DataFrame, shared: Broadcast, number: int, discount: float, strength: float, keep: bool) -> DataFrame:
    """Seats the pairs of near tokens anew; ``shared``: near tokens' tables as contexts and probabilities as dishes."""

    def seat_all(batches):
        near_tables, near_parent = shared.value
        for row, pair, n, t, kept in _rows_of(batches, "pair", "n", "t", "kept"):
            many = np.flatnonzero(n > 1)
            u, w = np.divmod(pair[many], len(near_tables))
            t = t.copy()
            t[many] = seat(n[many], near_tables[u] - t[many], near_parent[w], discount, strength, _key(u, w), number)
            bounds = np.array([0, len(pair)])
            yield pa.RecordBatch.from_arrays([*row.columns[:3], tx.lists(t, bounds), tx.lists(kept + t if keep else kept, bounds)], names=row.schema.names)

    return blocks.mapInArrow(seat_all, _BLOCKS_DDL)


def _gaps_near(blocks: DataFrame, size: int) -> DataFrame:
    """``slice, token, as_u, as_w``, arrays for each slice: customers less tables of each of ``size`` near tokens, as context and as dish."""
    cuts = np.arange(0, size + SLICE, SLICE)

    def found(tokens, as_u, as_w):
        some = np.flatnonzero(as_u | as_w)
        return _by_cut(_GAPS, "slice", np.searchsorted(some + tokens, cuts), token=some + tokens, as_u=as_u[some], as_w=as_w[some])

    def add(batches):
        as_u, as_w = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for _, pair, n, t in _rows_of(batches, "pair", "n", "t"):
            gap = n - t
            at = np.flatnonzero(gap)
            u, w = np.divmod(pair[at], size)
            np.add.at(as_u, u, gap[at])
            np.add.at(as_w, w, gap[at])
        yield found(0, as_u, as_w)

    def together(table):
        first = int(cuts[table["slice"][0].as_py()])
        token = _flat(table, "token") - first
        as_u, as_w = np.zeros(SLICE, np.int64), np.zeros(SLICE, np.int64)
        np.add.at(as_u, token, _flat(table, "as_u"))
        np.add.at(as_w, token, _flat(table, "as_w"))
        return pa.Table.from_batches([found(first, as_u, as_w)])

    return blocks.select("pair", "n", "t").mapInArrow(add, _GAPS_DDL).groupBy("slice").applyInArrow(together, _GAPS_DDL)


def _sweep_far(state: DataFrame, far: DataFrame, shared: Broadcast, number: int, discount: float, strength: float, keep: bool) -> DataFrame:
    """Seats all other pairs anew; ``shared``: near tokens' tables as contexts and probabilities as dishes, ``far`` the others'."""

    def seat_all(batches):
        near_tables, near_parent = shared.value
        for batch in _merged(batches):
            u, w, n, t, kept = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            total = batch.column(5).fill_null(0).to_numpy(zero_copy_only=False).copy()
            p = batch.column(6).fill_null(0.0).to_numpy(zero_copy_only=False).copy()
            total[u >= 0] = near_tables[u[u >= 0]]
            p[w >= 0] = near_parent[w[w >= 0]]
            t = seat(n, total - t, p, discount, strength, _key(u, w), number)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(t), pa.array(kept + t if keep else kept)], names=["u", "w", "n", "t", "kept"]
            )

    rest = state.withColumns({"ku": _spread("u", "w"), "kw": _spread("w", "u")})
    rest = rest.join(far.select(F.col("token").alias("ku"), "total"), "ku", "left").join(far.select(F.col("token").alias("kw"), "p"), "kw", "left")
    return rest.select("u", "w", "n", "t", "kept", "total", "p").mapInArrow(seat_all, "u bigint, w bigint, n bigint, t bigint, kept bigint")


def train(
    docs: DataFrame, discount: float = DISCOUNT, strength: float = STRENGTH, burn_in: int = BURN_IN, samples: int = SAMPLES,
    near: int = NEAR,
) -> tuple[Model, DataFrame, Pairs]:
    """(model, far tokens, pairs) from ``docs`` (``_text, _train``).

    Far tokens: ``token, n, share, parent``, the arrays by sample and null where n = 1. A pair's mass is its customers less
    discounted tables, averaged; of near pairs, ``kept`` is the sum of the tables.
    """
    counts = stored(token_counts(docs.filter("_train"), "_text"), "tokens")
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Whole groups of equal counts, as many as fit: no order over the vocabulary is needed.
    least = _least(counts, near)
    end = int(tx.signed(np.array([END]))[0])
    top = counts.filter((F.col("n") >= least) | (F.col("token") == end)).toArrow()
    token, n = top["token"].to_numpy().view(np.uint64), top["n"].to_numpy()
    if END not in token:
        token, n = np.append(token, END), np.append(n, 0)
    order = np.argsort(token)
    token, n = token[order], n[order]
    del top, order
    far_counts = counts.filter((F.col("n") < least) & (F.col("token") != end)).select(
        F.col("token").bitwiseOR(F.lit(-(2**63))).alias("token"), "n"
    )
    one = F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    # Each broadcast goes when what reads it is written, so that the driver never holds more than one.
    known = docs.sparkSession.sparkContext.broadcast(token)
    size = len(token)
    buckets = max(1, min(-(-int(total) // BUCKET), 2**62 // size**2))
    pairs = stored(pair_counts(docs, known, buckets), "pairs")
    known.destroy()
    blocks = pairs.select("bucket", "pair", "n", F.transform("n", lambda _: one).alias("t"), F.transform("n", lambda _: zero).alias("kept"))
    far_pairs = pairs.select(F.explode(F.arrays_zip("far_u", "far_w", "far_n")).alias("x")).select(
        F.col("x.far_u").alias("u"), F.col("x.far_w").alias("w"), F.col("x.far_n").alias("n")
    )
    state = far_pairs.filter("n > 1").select("u", "w", "n", one.alias("t"), zero.alias("kept"))
    root = np.minimum(n, 1)
    far = far_counts.filter("n > 1").select(
        "token", "n", one.alias("root"), F.array().cast("array<double>").alias("share"), F.array().cast("array<double>").alias("parent")
    )
    root_total = int(kinds)
    shares, parents, once, unseen = [], [], [], []
    written = []

    def cut(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(df.sparkSession, name)
        with shuffles_let_go(df.sparkSession):
            df.write.parquet(path)
        written.append(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def follow(number: int, keep: bool):
        """Tables of every context, customers and tables of the parent restaurant, and its probabilities."""
        nonlocal far, root, root_total
        gap = F.col("n") - F.col("t")
        ends = state.select(F.explode(F.array(
            F.struct(F.col("u").alias("token"), gap.alias("as_u"), zero.alias("as_w")),
            F.struct(F.col("w").alias("token"), zero.alias("as_u"), gap.alias("as_w")),
        )).alias("x")).select("x.*")
        gaps = cut(ends.groupBy("token").agg(F.sum("as_u").alias("as_u"), F.sum("as_w").alias("as_w")), "gaps")
        tables, customers = n.copy(), n.copy()
        inside = _gaps_near(blocks, size).select(F.explode(F.arrays_zip("token", "as_u", "as_w")).alias("x")).select("x.*")
        for mine in (gaps.filter(~_far("token")), inside):
            with shuffles_let_go(docs.sparkSession):
                here = mine.toArrow()
            for batch in here.to_batches():
                at = batch.column("token").to_numpy()
                tables[at] -= batch.column("as_u").to_numpy()
                customers[at] -= batch.column("as_w").to_numpy()
            del here
        root = _seat_roots(customers, root_total - root, discount, strength, token, 1000 + number)
        seated = far.join(gaps.filter(_far("token")), "token", "left").select(
            "token", "n", "root", "share", "parent", (F.col("n") - F.coalesce("as_u", zero)).alias("total"),
            (F.col("n") - F.coalesce("as_w", zero)).alias("customers"),
        )
        before = root_total

        def seat_far(batches):
            for batch in _merged(batches):
                key, own, c = (batch.column(k).to_numpy() for k in (0, 2, 6))
                new = seat(c, before - own, np.zeros(len(c)), discount, strength, key.astype(np.int64).view(np.uint64), 1000 + number)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(new), *batch.columns[3:]], names=batch.schema.names)

        moved = cut(seated.mapInArrow(seat_far, seated.schema), "words")
        far_root, far_customers, far_kinds = moved.agg(
            F.coalesce(F.sum("root"), zero), F.coalesce(F.sum("customers"), zero), F.count("*")
        ).first()
        single = int(kinds) - far_kinds - int((n > 0).sum())
        root_total = int(root.sum()) + far_root + single
        scale = strength + int(customers.sum()) + far_customers + single
        spare = (strength + discount * root_total) / scale
        p = np.where(n > 0, (customers - discount * root) / scale, spare)
        far = moved.withColumn("p", (F.col("customers") - discount * F.col("root")) / scale)
        if keep:
            share = (strength + discount * F.col("total")) / (strength + F.col("n"))
            far = far.withColumns({"share": F.concat("share", F.array(share)), "parent": F.concat("parent", F.array("p"))})
            shares.append(((strength + discount * tables) / (strength + n)).astype(np.float32))
            parents.append(p.astype(np.float32))
            once.append((1 - discount) / scale)
            unseen.append(spare)
        return tables, p

    tables, p = follow(-1, False)
    for number in range(burn_in + samples):
        keep = number >= burn_in
        before = list(written)
        shared = docs.sparkSession.sparkContext.broadcast((tables, p))
        del tables, p
        blocks = cut(_sweep_near(blocks, shared, number, discount, strength, keep), "blocks")
        state = cut(_sweep_far(state, far, shared, number, discount, strength, keep), "seats")
        shared.destroy()
        tables, p = follow(number, keep)
        # Nothing reads the sweep before any more.
        for path in before:
            files.remove(docs.sparkSession, path)
            written.remove(path)
    model = Model(token, n, *(np.array(x, dtype=np.float32) for x in (shares, parents, once, unseen)), int(total), int(kinds))
    mass = F.col("n") - discount * F.col("kept") / samples
    seen = state.select("u", "w", mass.alias("mass")).unionByName(far_pairs.filter("n = 1").select("u", "w", F.lit(1 - discount).alias("mass")))
    return model, far_counts.join(far.select("token", "share", "parent"), "token", "left"), Pairs(blocks, seen, buckets)


def _least(counted: DataFrame, most: int) -> int:
    """The smallest count n for which at most ``most`` rows have it or a larger one; found among at most 64 powers of a half."""
    step = F.floor(F.log2("n") * 2).cast("int")
    rows = sorted(counted.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("n")).collect(), reverse=True)
    least, seen = 2**62, 0
    for row in rows:
        seen += row["rows"]
        if seen > most:
            break
        least = row["n"]
    return least


def _mean_of_products(share: np.ndarray, parent: np.ndarray) -> np.ndarray:
    return sum(a * b for a, b in zip(share, parent)) / len(share)


_ASKED, _ASKED_DDL = _schema(
    "bucket", pair=_LONG, key=_LONG, times=pa.int32(), train=pa.bool_(),
    far=_LONG, other=_LONG, far_key=_LONG, far_times=pa.int32(), far_train=pa.bool_(),
    own_key=_LONG, n_tokens=_LONG, n_known=_LONG, base=_DOUBLE, value=_DOUBLE,
)
_ANSWERED, _ANSWERED_DDL = _schema(
    "part", key=_LONG, value=_DOUBLE, own_key=_LONG, own=_LONG, n_tokens=_LONG, n_known=_LONG, base=_DOUBLE, own_value=_DOUBLE
)
_SUMS_DDL = "_key bigint, n_tokens bigint, n_known bigint, base double, value double, own int"


def score(
    docs: DataFrame, train_on: Column, id_column: str = "doc_id", text: str = "text", discount: float = DISCOUNT,
    strength: float = STRENGTH, burn_in: int = BURN_IN, samples: int = SAMPLES, near: int = NEAR, pairs: int = PAIRS,
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` for every row.

    ``train_on`` picks the rows to learn from. Tokens are runs without ASCII white space, A-Z lowered, and one end for each
    text; a null text is empty and has the end only. All unknown tokens share one outcome; without any training text every
    token is unknown. Rows that share id and text have equal results; ids may be null.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"), train_on.alias("_train"))
    model, far, seen = train(plain, discount, strength, burn_in, samples, near)
    size, buckets = len(model.near), seen.buckets
    with shuffles_let_go(spark):
        least = _least(seen.near.select(F.explode("n").alias("n")), pairs)

    def masses(n, kept):
        return n - discount * kept / samples

    def most(batches):
        for _, pair, n, kept in _rows_of(batches, "pair", "n", "kept"):
            top = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(_hash(pair[top]))), pa.array(masses(n[top], kept[top]))], names=["key", "mass"])

    def less(batches):
        for _, pair, n in _rows_of(batches, "pair", "n"):
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(_hash(pair[n < least])))], names=["key"])

    top = seen.near.select("pair", "n", "kept").mapInArrow(most, "key bigint, mass double").toArrow()
    packed = top["key"].to_numpy().view(np.uint64)
    order = np.argsort(packed)
    packed, heavy = packed[order], top["mass"].to_numpy()[order].astype(np.float32)
    del top, order
    with shuffles_let_go(spark):
        others = bloom.bitmap(seen.near.select("pair", "n").mapInArrow(less, "key bigint"), "key")
    shared = spark.sparkContext.broadcast((tuple(model), packed, heavy, others))
    scale = np.log10(model.total + model.kinds + 1) if model.total else 0.0
    total = model.total
    del packed, heavy, others, model

    def ask(batches):
        """Each document's own sums, and the pairs that have to meet their bucket, a row of arrays for each bucket; none of two far tokens."""
        values, packed, mass, others = shared.value
        m = Model(*values)
        base_near = np.where(m.count > 0, np.log10(m.count + 1.0) - scale, 0.0 - scale)
        starts, starts_packed = _starts(m.near), _starts(packed)
        end = _numbers(m.near, np.array([END]), starts)
        held, length = [], 0

        def dealt(at, doc, key, train, kind, **values):
            """A row for each bucket: the values, and in how many of them each document has a share."""
            order = np.argsort(at.astype(np.uint16) if buckets < 1 << 16 else at, kind="stable")
            at, doc = at[order], doc[order]
            new = np.ones(len(at), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])
            first = np.flatnonzero(new)
            runs = {"key": key[doc[first]], "times": np.diff(np.append(first, len(at))), "train": train[doc[first]]}
            numbers = np.arange(buckets + 1)
            asked = _by_cut(_ASKED, "bucket", np.searchsorted(at, numbers), **{x: v[order] for x, v in values.items()})
            by_run = _by_cut(_ASKED, "bucket", np.searchsorted(at[first], numbers), **{kind + x: v for x, v in runs.items()})
            return pa.RecordBatch.from_arrays([a if f.name in values else b for f, a, b in zip(_ASKED, asked, by_run)], schema=_ASKED)

        def piece():
            key, train, n_tokens, n_known, base, value = (np.concatenate([x[k] for x in held]) for k in range(6))
            pair, count, alone, other, alone_count = (np.concatenate([x[k] for x in held]) for k in range(6, 11))
            doc = np.arange(len(key))
            yield dealt(_bucket(_hash(pair), buckets), np.repeat(doc, count), key, train, "", pair=pair)
            yield dealt(_bucket(alone.view(np.uint64), buckets), np.repeat(doc, alone_count), key, train, "far_", far=alone, other=other)
            # The documents' own rows go to any bucket.
            bounds = np.array([0, len(key)])
            own = {"own_key": key, "n_tokens": n_tokens, "n_known": n_known, "base": base, "value": value}
            where = pa.array([int(key[0]) % buckets], type=pa.int32())
            yield pa.RecordBatch.from_arrays(
                [where if f.name == "bucket" else tx.lists(own[f.name], bounds) if f.name in own else pa.nulls(1, f.type) for f in _ASKED],
                schema=_ASKED,
            )

        for batch in batches:
            train = batch.column(2).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy()
            for i, j, raw, offsets in tx.slices(batch.column(0)):
                tokens, first = _tokens(raw, offsets)
                w = _numbers(m.near, tokens, starts)
                u = np.concatenate([end, w[:-1]])
                doc = np.repeat(np.arange(j - i), np.diff(first))
                at = np.flatnonzero((u >= 0) & (w >= 0))
                pair = u[at] * size + w[at]
                hashed = _hash(pair)
                place, found = _places(packed, starts_packed, hashed)
                # A pair that is nowhere has one customer in training, the document's own, and none outside.
                own_mass = np.where(train[i:j][doc[at]], 1 - discount, 0.0)
                own_mass[found] = mass[place[found]]
                missing = np.flatnonzero(~found)
                unsure = missing[bloom.hits(others, hashed[missing])]
                found[missing] = True
                found[unsure] = False
                hit = at[found]
                p = own_mass[found] / (strength + m.count[u[hit]]) + _mean_of_products(m.share[:, u[hit]], m.parent[:, w[hit]])
                value = np.zeros(len(tokens))
                value[hit] = np.log10(p)
                base, known = np.zeros(len(tokens)), np.zeros(len(tokens), np.int64)
                is_near = w >= 0
                base[is_near] = base_near[w[is_near]]
                known[is_near] = m.count[w[is_near]] > 0
                sums = [np.add.reduceat(x, first[:-1]) for x in (known, base, value)]
                asked = np.bincount(doc[at[unsure]], minlength=j - i)
                # One far token: with the near one behind it, or with the complement of the one before it.
                alone = np.flatnonzero((u < 0) != (w < 0))
                us, ws = u[alone], w[alone]
                held.append((
                    keys[i:j], train[i:j], np.diff(first), *sums, pair[unsure], asked, np.where(us < 0, us, ws), np.where(us < 0, ws, ~us),
                    np.bincount(doc[alone], minlength=j - i),
                ))
                length += len(tokens)
                if length >= PIECE:
                    yield from piece()
                    held, length = [], 0
        if held:
            yield from piece()

    parts = buckets // 8 + 1

    def far_sums(asked, known, m):
        """By document: known tokens, base and score of the pairs with one far token, whose bucket has that token."""
        alone, other, times, train = (_flat(asked, x) for x in ("far", "other", "far_times", "far_train"))
        if not len(alone):
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        token, n = _flat(known, "token"), _flat(known, "count")
        # Without a place among them: a token that training does not have.
        n = np.append(n, 0)
        share, parent = np.ones((samples, len(n))), np.repeat(m.unseen.astype(np.float64)[:, None], len(n), axis=1)
        share[:, n == 1], parent[:, n == 1] = (strength + discount) / (strength + 1), m.once[:, None]
        many = n > 1
        share[:, many], parent[:, many] = (_flat(known, x).reshape(-1, samples).T for x in ("share", "parent"))
        order = np.argsort(token)
        place = np.append(order, len(token))[np.searchsorted(token[order], alone)]
        place[np.append(token, 0)[place] != alone] = len(token)
        as_context = other >= 0
        near = np.where(as_context, other, ~other)
        have = [_flat(known, x) for x in ("alone", "other", "mass")]
        keys = _key(have[0], have[1])
        order = np.argsort(keys)
        have = [x[order] for x in have]
        mass = np.where(np.repeat(train, times), 1 - discount, 0.0)
        if len(keys):
            at = np.minimum(np.searchsorted(keys[order], _key(alone, other)), len(keys) - 1)
            found = (have[0][at] == alone) & (have[1][at] == other)
            mass[found] = have[2][at[found]]
        p = np.zeros(len(alone))
        for k in range(samples):
            p += np.where(as_context, share[k][place], m.share[k][near]) * np.where(as_context, m.parent[k][near], parent[k][place]) / samples
        p += mass / (strength + np.where(as_context, n[place], m.count[near]))
        base = np.where(as_context, 0.0, np.log10(n[place] + 1.0) - scale)
        first = np.cumsum(times) - times
        return tuple(np.add.reduceat(x, first) for x in ((~as_context & (n[place] > 0)).astype(np.int64), base, np.log10(p)))

    def answer(asked, known):
        """Sums of the looked-up pairs, a row of arrays for each part of the documents."""
        values, *_ = shared.value
        m = Model(*values)
        if not asked.num_rows:
            return _ANSWERED.empty_table()
        pair, key, times, train = (_flat(asked, x) for x in ("pair", "key", "times", "train"))
        sums = np.zeros(0)
        if len(pair):
            have, n, kept = (_flat(known, x) for x in ("pair", "n", "kept"))
            mass = np.where(np.repeat(train, times), 1 - discount, 0.0)
            if len(have):
                place = np.minimum(np.searchsorted(have, pair), len(have) - 1)
                found = have[place] == pair
                mass[found] = masses(n, kept)[place[found]]
            u, w = np.divmod(pair, size)
            p = np.zeros(len(pair))
            for k in range(samples):
                p += m.share[k][u].astype(np.float64) * m.parent[k][w] / samples
            sums = np.add.reduceat(np.log10(p + mass / (strength + m.count[u])), np.cumsum(times) - times)
        own_key, far_key = _flat(asked, "own_key"), _flat(asked, "far_key")
        far_known, far_base, far_value = far_sums(asked, known, m)
        none = np.zeros(len(far_key), np.int64)
        own = {"own_key": (own_key, far_key), "own": (np.ones(len(own_key), np.int64), none), "n_tokens": (_flat(asked, "n_tokens"), none)}
        own |= {"n_known": (_flat(asked, "n_known"), far_known), "base": (_flat(asked, "base"), far_base), "own_value": (_flat(asked, "value"), far_value)}
        out = []
        for at, columns in ((key, {"key": key, "value": sums}), (np.concatenate(own["own_key"]), {x: np.concatenate(v) for x, v in own.items()})):
            at = at % parts
            order = np.argsort(at, kind="stable")
            cuts = np.searchsorted(at[order], np.arange(parts + 1))
            out.append(_by_cut(_ANSWERED, "part", cuts, **{x: v[order] for x, v in columns.items()}))
        return pa.Table.from_batches(out)

    def together(table):
        key, own_key = _flat(table, "key"), _flat(table, "own_key")
        # Rows that share id and text share a key: sums go to all of them.
        keys, at = np.unique(own_key, return_inverse=True)
        sums = {x: np.bincount(at, _flat(table, x), len(keys)) for x in ("own", "n_tokens", "n_known", "base", "own_value")}
        value = sums["own_value"] + np.bincount(np.searchsorted(keys, key), _flat(table, "value"), len(keys))
        return pa.Table.from_arrays(
            [
                pa.array(keys), pa.array(sums["n_tokens"].astype(np.int64)), pa.array(sums["n_known"].astype(np.int64)),
                pa.array(sums["base"]), pa.array(value), pa.array(sums["own"].astype(np.int32)),
            ],
            names=["_key", "n_tokens", "n_known", "base", "value", "own"],
        )

    def ask_far(batches):
        """Pairs of two far tokens, one row for each of a document."""
        values, *_ = shared.value
        m = Model(*values)
        starts = _starts(m.near)
        end = _numbers(m.near, np.array([END]), starts)
        for batch in batches:
            train = batch.column(2).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy()
            for i, j, raw, offsets in tx.slices(batch.column(0)):
                tokens, first = _tokens(raw, offsets)
                w = _numbers(m.near, tokens, starts)
                u = np.concatenate([end, w[:-1]])
                at = np.flatnonzero((u < 0) & (w < 0))
                doc = np.searchsorted(first, at, side="right") - 1
                index, times = _distinct_pairs(u[at], w[at], doc)
                # In text order, so that a document's rows stay together.
                order = np.argsort(index)
                index, times = index[order], times[order]
                at, doc = at[index], i + doc[index]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[doc]), pa.array(u[at]), pa.array(w[at]), pa.array(times.astype(np.int32)), pa.array(train[doc])],
                    names=["_key", "u", "w", "times", "train"],
                )

    def value(batches):
        """Adds the looked-up pairs, of which ``mass`` and for far tokens ``n_u, n_w`` and the samples are given."""
        values, *_ = shared.value
        m = Model(*values)
        for batch in batches:
            col = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            as_numpy = lambda name, empty: col[name].fill_null(empty).to_numpy(zero_copy_only=False)
            u, w, times, train = (col[x].to_numpy(zero_copy_only=False) for x in ("u", "w", "times", "train"))
            mass = np.where(col["mass"].is_null().to_numpy(zero_copy_only=False), np.where(train, 1 - discount, 0.0), as_numpy("mass", 0.0))
            n_u, n_w = as_numpy("n_u", 0), as_numpy("n_w", 0)
            p = np.zeros(len(u))
            for k in range(samples):
                share = np.where(n_u > 1, as_numpy(f"share{k}", 0.0), np.where(n_u == 1, (strength + discount) / (strength + 1), 1.0))
                parent = np.where(n_w > 1, as_numpy(f"parent{k}", 0.0), np.where(n_w == 1, m.once[k], m.unseen[k]))
                p += share * parent / samples
            p += mass / (strength + n_u)
            none = np.zeros(len(u), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    col["_key"], pa.array(none), pa.array(np.where(n_w > 0, times, 0).astype(np.int64)),
                    pa.array(times * (np.log10(n_w + 1.0) - scale)), pa.array(times * np.log10(p)),
                    pa.array(none.astype(np.int32)),
                ],
                names=["_key", "n_tokens", "n_known", "base", "value", "own"],
            )

    keyed = plain.withColumn("_key", F.xxhash64("_id", "_text"))
    read = keyed.select("_text", "_key", "_train")
    # The buckets of far tokens follow from their own hashes, as in _bucket.
    bucket = lambda token: (F.shiftrightunsigned(token, 32) % F.lit(buckets)).cast("int")
    with_one = seen.far.filter(_far("u") != _far("w")).select(
        F.when(_far("u"), F.col("u")).otherwise(F.col("w")).alias("alone"), F.when(_far("u"), F.col("w")).otherwise(F.bitwise_not("u")).alias("other"), "mass"
    )

    def gathered(rows, token, *columns):
        """A row of arrays for each bucket."""
        found = rows.groupBy(bucket(token).alias("bucket")).agg(F.collect_list(F.struct(*columns)).alias("x"))
        lists = found.select("bucket", *[F.col("x")[c].alias(c) for c in columns])
        # Only tokens that occur twice or more have shares.
        return lists.withColumns({c: F.flatten(c) for c in columns if c in ("share", "parent")})

    empty = F.array().cast("array<double>")
    tokens = far.select("token", F.col("n").alias("count"), F.coalesce("share", empty).alias("share"), F.coalesce("parent", empty).alias("parent"))
    known = seen.near.select("bucket", "pair", "n", "kept")
    known = known.unionByName(gathered(tokens, "token", "token", "count", "share", "parent"), allowMissingColumns=True)
    known = known.unionByName(gathered(with_one, "alone", "alone", "other", "mass"), allowMissingColumns=True)
    met = read.mapInArrow(ask, _ASKED_DDL).groupBy("bucket").cogroup(known.groupBy("bucket"))
    inner = met.applyInArrow(answer, _ANSWERED_DDL).groupBy("part").applyInArrow(together, _SUMS_DDL)
    outer = read.mapInArrow(ask_far, "_key bigint, u bigint, w bigint, times int, train boolean")
    outer = outer.join(seen.far.filter(_far("u") & _far("w")), ["u", "w"], "left")
    outer = outer.join(far.select(F.col("token").alias("u"), F.col("n").alias("n_u"), *[F.col("share")[k].alias(f"share{k}") for k in range(samples)]), "u", "left")
    outer = outer.join(far.select(F.col("token").alias("w"), F.col("n").alias("n_w"), *[F.col("parent")[k].alias(f"parent{k}") for k in range(samples)]), "w", "left")
    sums = [F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "value", "own")]

    # One after the other, so that the exchanged pairs of only one of them are on the disks.
    inner = stored(inner, "inner")
    outer = stored(outer.mapInArrow(value, _SUMS_DDL).groupBy("_key").agg(*sums), "outer")
    parts = inner.unionByName(outer)
    # Equal rows have equal keys, so their sums are shared out again.
    summed = parts.groupBy("_key").agg(*sums)
    each = lambda x: F.col(x) / F.col("own")
    whole = lambda x: F.floor(each(x)).cast("bigint")
    results = summed.select(
        "_key", whole("n_tokens").alias("n_tokens"), whole("n_known").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), each("base").alias("base_score"), each("value").alias("score"),
        F.pow(F.lit(10.0), -F.col("value") / F.col("n_tokens")).alias("perplexity"),
    )
    ids = keyed.select(F.col("_id").alias("doc_id"), "_key")
    return ids.join(results, "_key").drop("_key")
