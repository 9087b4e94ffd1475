"""First string in scan order that contains, or is contained in, another.

Probes of at most ``AUTOMATON_BYTES`` together become one Aho-Corasick automaton, and every host is scanned once: the
work is the hosts' length and the hits, however common a probe is.

More probes than that are indexed. If p lies in h then every trigram of p is a trigram of h. A probe is joined on its
rarest trigram only, and the join condition verifies the containment. Probes whose
rarest trigram is still common (a city name, say) are not paired: they go through the automaton if they fit, and else
the hosts' substrings of just the lengths that occur are reduced to one row per distinct
substring and looked up by equality. All ways are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import keyed_join

_N = 3
# Hosts a probe may meet through its rarest trigram; above this the lookup is used.
COMMON = 1000
#: UTF-8 bytes of the probes that one automaton takes; each task holds one, of some fifty times that size.
AUTOMATON_BYTES = 2 << 20


def _listed(probes: DataFrame, *columns: str) -> list[tuple] | None:
    """The probes' rows if an automaton may hold them; their size is measured first."""
    size = probes.agg(F.sum(F.octet_length("p").cast("long") + 8)).first()[0] or 0
    return [tuple(r) for r in probes.select("p", *columns).collect()] if size <= AUTOMATON_BYTES else None


def _automaton(words: list[tuple]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, value in words:
        found.add_word(word, value)
    found.make_automaton()
    return found


def _first_host_scanned(probes: list[tuple], hosts: DataFrame) -> DataFrame:
    """(p, ord) as ``first_host`` gives it; a task reports each probe once."""
    words = [(p, k) for k, (p,) in enumerate(probes)]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, best = _automaton(words), {}
        for batch in batches:
            for h, ord_ in zip(*(c.to_pylist() for c in batch.columns)):
                for k in {k for _, k in search.iter(h)}:
                    if k not in best or ord_ < best[k]:
                        best[k] = ord_
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[k][0] for k in best], pa.string()), pa.array(list(best.values()), pa.int64())], names=["p", "ord"]
            )

    rows = hosts.select("h", F.col("ord").cast("long").alias("ord")).mapInArrow(scanned, "p string, ord long")
    return rows.groupBy("p").agg(F.min("ord").alias("ord"))


def _first_probe_scanned(probes: list[tuple], hosts: DataFrame) -> DataFrame:
    """(h, ord) as ``first_probe_inside`` gives it: one row per host that holds a probe."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _automaton(probes)
        for batch in batches:
            found = [(h, min((o for _, o in search.iter(h)), default=None)) for h in batch.column(0).to_pylist()]
            held = [(h, o) for h, o in found if o is not None]
            if held:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in held], pa.string()), pa.array([o for _, o in held], pa.int64())],
                    names=["h", "ord"],
                )

    return hosts.select("h").mapInArrow(scanned, "h string, ord long")


def _windows(text: Column, size: Column) -> Column:
    """All distinct substrings of one length; empty when the text is shorter."""
    last = F.length(text) - size + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, size)))


def _host_grams(hosts: DataFrame, shortest: int) -> DataFrame:
    """(h, gram): trigrams, plus shorter grams when some probe is shorter than that."""
    sizes = range(max(min(_N, shortest), 1), _N + 1)
    grams = F.flatten(F.array(*[_windows(F.col("h"), F.lit(n)) for n in sizes]))
    return hosts.select("h", F.explode(grams).alias("gram"))


def _rarest(probes: DataFrame, host_grams: DataFrame) -> DataFrame:
    """(p, gram, df): each probe's rarest gram; probes with a gram no host has are dropped."""
    frequency = host_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    size = F.least(F.length("p"), F.lit(_N))
    grams = probes.select("p", F.explode(_windows(F.col("p"), size)).alias("gram"))
    met = keyed_join(grams, frequency, ["gram"], "left")
    return (
        met.groupBy("p")
        .agg(
            F.min_by("gram", F.struct("df", "gram")).alias("gram"),
            F.min("df").alias("df"),
            F.count_if(F.col("df").isNull()).alias("missing"),
        )
        .filter(F.col("missing") == 0)
        .select("p", "gram", "df")
    )


def _substrings(hosts: DataFrame, wanted: DataFrame, lengths: list[int]) -> DataFrame:
    """Host rows repeated per distinct substring that equals some wanted probe."""
    sizes = F.array(*[F.lit(n) for n in lengths])
    pieces = F.flatten(F.transform(sizes, lambda n: _windows(F.col("h"), n)))
    rows = hosts.withColumn("p", F.explode(pieces))
    return keyed_join(rows, wanted.select("p"), ["p"], "left_semi")


class _Split:
    """Probes divided by how common their rarest gram is among the hosts."""

    def __init__(self, probes: DataFrame, hosts: DataFrame, common: int):
        shortest = probes.agg(F.min(F.length("p"))).first()[0]
        self.grams = _host_grams(hosts.select("h"), _N if shortest is None else shortest)
        rarest = cut_lineage(_rarest(probes.select("p"), self.grams))
        self.cold = rarest.filter(F.col("df") <= common)
        self.hot = rarest.filter(F.col("df") > common)
        # Distinct lengths only: no longer than the longest probe.
        lengths = self.hot.select(F.length("p").alias("n")).distinct().collect()
        self.hot_lengths = sorted(r.n for r in lengths)


def _cold_pairs(split: _Split) -> DataFrame:
    return keyed_join(
        split.grams, split.cold.select("p", "gram"), ["gram"], "inner",
        residual=F.contains(F.col("h"), F.col("p")),
    ).select("h", "p")


def first_host(probes: DataFrame, hosts: DataFrame, common: int = COMMON) -> DataFrame:
    """(p, ord): for every probe p the smallest ``ord`` of the hosts h that contain it.

    ``probes`` has distinct p, ``hosts`` has distinct h with ord. No string is empty.
    """
    probes = cut_lineage(probes)
    if (words := _listed(probes)) is not None:
        return _first_host_scanned(words, hosts) if words else hosts.select(F.col("h").alias("p"), "ord").limit(0)
    hosts = cut_lineage(hosts)
    split = _Split(probes, hosts, common)
    few = keyed_join(_cold_pairs(split), hosts, ["h"], "inner")
    found = few.groupBy("p").agg(F.min("ord").alias("ord"))
    if split.hot_lengths:
        if (words := _listed(split.hot)) is not None:
            return found.unionByName(_first_host_scanned(words, hosts))
        # Reduced to one row per substring before it meets the probes.
        many = _substrings(hosts, split.hot, split.hot_lengths)
        found = found.unionByName(many.groupBy("p").agg(F.min("ord").alias("ord")))
    return found


def first_probe_inside(probes: DataFrame, hosts: DataFrame, common: int = COMMON) -> DataFrame:
    """(h, ord): for every host h the smallest ``ord`` of the probes p it contains.

    ``hosts`` has distinct h, ``probes`` has distinct p with ord. No string is empty.
    """
    probes = cut_lineage(probes.withColumn("ord", F.col("ord").cast("long")))
    if (words := _listed(probes, "ord")) is not None:
        return _first_probe_scanned(words, hosts) if words else hosts.select("h", F.lit(0).cast("long").alias("ord")).limit(0)
    hosts = cut_lineage(hosts)
    split = _Split(probes, hosts, common)
    found = keyed_join(_cold_pairs(split), probes, ["p"], "inner").select("h", "ord")
    if split.hot_lengths and (words := _listed(keyed_join(probes, split.hot.select("p"), ["p"], "left_semi"), "ord")) is not None:
        found = found.unionByName(_first_probe_scanned(words, hosts))
    elif split.hot_lengths:
        many = _substrings(hosts.select("h"), split.hot, split.hot_lengths)
        found = found.unionByName(keyed_join(many, probes, ["p"], "inner").select("h", "ord"))
    return found.groupBy("h").agg(F.min("ord").alias("ord"))
