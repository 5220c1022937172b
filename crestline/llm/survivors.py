"""One surviving record per duplicate group, built from consistent bundles of fields.

Fields that only make sense together (a file and the strategy that found it) form a bundle and are taken whole from one
record. A choice takes a candidate for every bundle, under functional dependencies: a later bundle must agree with the
earlier ones on its determinant fields, else it stays empty. Every bundle adds to the trust of a choice, a vector of tiers
that is compared from left to right; bundles that share a tier are traded off against each other, as their parts add up.
The search is a branch-and-bound over all groups at once, one level per bundle:

* dominance: of the candidates of a source that agree in the determinants and in the fields that later bundles depend on, only
  the best can be in an optimum; they are found by a combining aggregation per source, so hot sources are no matter;
* bound: what a choice has so far plus the best that any candidate of the group offers for each bundle still to come. The order
  of vectors is kept by addition, so no completion can be better;
* incumbent: what a choice comes to even if all bundles to come stay empty can be had; where that leaves several choices of a
  group open, the most promising one is completed first, greedily;
* branch: the choices whose bound reaches the incumbent are extended by all candidates that agree, and bounded again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.operators.joins import spread_join
from crestline.plans.scratch import Scratch

EMPTY, UNKNOWN = -(1 << 56), -(1 << 55)  # trust of a bundle without a candidate, and of a part that is null


@dataclass(frozen=True)
class Bundle:
    name: str
    fields: list[str]
    trust: list[Column]  # whole numbers under 2^55, null below all
    usable: Column | None = None
    determinants: list[str] = field(default_factory=list)  # fields of earlier bundles, or the source
    tiers: list[int] | None = None  # where each part adds to the vector; None: tiers of its own after all so far


def _tiers(bundles: list[Bundle]) -> tuple[list[list[int]], int]:
    out, n = [], 0
    for b in bundles:
        own = b.tiers if b.tiers is not None else list(range(n, n + len(b.trust)))
        out.append(own)
        n = max([n, *(k + 1 for k in own)])
    return out, n


class _Search:
    def __init__(self, members: DataFrame, group: list[str], source: str, records: DataFrame, bundles: list[Bundle], cut: Scratch):
        self.group, self.source, self.bundles, self.cut = group, source, bundles, cut
        self.tiers, self.width = _tiers(bundles)
        self.records = records
        self.belongs = cut.cut(members.select(*group, F.col(f"`{source}`").alias("__source")).where(F.col("__source").isNotNull()).distinct())

    def vector(self, level: int, parts: list[Column]) -> Column:
        """What a bundle adds, as a struct of its tiers in their order; the others are 0."""
        at = {t: p for t, p in zip(self.tiers[level], parts)}
        return F.struct(*(F.coalesce(at[k].cast("long"), F.lit(UNKNOWN)).alias(f"t{k}") for k in sorted(at)))

    def empty(self, level: int) -> Column:
        return F.struct(*(F.lit(EMPTY).cast("long").alias(f"t{k}") for k in sorted(self.tiers[level])))

    def plus(self, total: Column | None, added: dict[int, Column]) -> Column:
        """A vector of all tiers and what some levels add."""
        zero = F.lit(0).cast("long")
        return F.struct(*(sum((v[f"t{k}"] for level, v in added.items() if k in self.tiers[level]), zero if total is None else total[f"t{k}"]).alias(f"t{k}") for k in range(self.width)))

    def offer(self, level: int) -> Column:
        """Trust and fields of a record as this bundle's candidate, or null. Fields after the trust make ties deterministic."""
        b = self.bundles[level]
        value = F.struct(self.vector(level, b.trust).alias("trust"), F.struct(*(F.col(f"`{f}`") for f in b.fields)).alias("fields"))
        return F.when(b.usable, value) if b.usable is not None else value

    def wanted_later(self, level: int) -> list[str]:
        """Fields of this bundle that later ones depend on, where this bundle is the first to have them."""
        before = {f for b in self.bundles[:level] for f in b.fields}
        later = {d for b in self.bundles[level + 1 :] for d in b.determinants if d != self.source}
        return [f for f in self.bundles[level].fields if f in later and f not in before]

    def candidates(self, level: int) -> DataFrame:
        """(source, determinants, bundle): the best of each source for all values that matter elsewhere."""
        b = self.bundles[level]
        keys = [F.col(f"`{self.source}`").alias("__source"), *(F.col(f"`{d}`").alias(f"__d_{d}") for d in b.determinants if d != self.source)]
        keys += [F.col(f"`{f}`").alias(f"__l_{f}") for f in self.wanted_later(level)]
        rows = self.records.where(b.usable) if b.usable is not None else self.records
        return rows.where(F.col(f"`{self.source}`").isNotNull()).groupBy(*keys).agg(F.max(self.offer(level)).alias(b.name)).drop(*(f"__l_{f}" for f in self.wanted_later(level)))

    def start(self) -> DataFrame:
        """Choices of the first bundle with what each later bundle could add at most in their group."""
        rest = [f"__rest{k}" for k in range(1, len(self.bundles))]
        first = self.bundles[0].name
        opened = self.belongs.join(self.candidates(0), "__source").select(*self.group, "__source", first, self.plus(None, {0: F.col(f"{first}.trust")}).alias("__trust"))
        if not rest:
            return self.cut.cut(opened)
        # one pass over the records for the bounds of all bundles
        each = self.records.where(F.col(f"`{self.source}`").isNotNull()).groupBy(F.col(f"`{self.source}`").alias("__source")).agg(
            *(F.max(F.when(b.usable if b.usable is not None else F.lit(True), self.vector(k, b.trust))).alias(f"__rest{k}") for k, b in enumerate(self.bundles) if k))
        bounds = self.belongs.join(each, "__source").groupBy(*self.group).agg(*(F.max(r).alias(r) for r in rest))
        bounds = bounds.select(*self.group, *(F.coalesce(r, self.empty(k)).alias(r) for k, r in enumerate(rest, 1)))
        return self.cut.cut(spread_join(self.cut.cut(opened), bounds, self.group))

    def bound(self, level: int) -> Column:
        """The most that a choice of the bundles up to this level can come to."""
        return self.plus(F.col("__trust"), {k: F.col(f"__rest{k}") for k in range(level + 1, len(self.bundles))})

    def at_least(self, level: int) -> Column:
        """What such a choice comes to if all bundles to come stay empty."""
        return self.plus(F.col("__trust"), {k: self.empty(k) for k in range(level + 1, len(self.bundles))})

    def extended(self, choices: DataFrame, level: int) -> DataFrame:
        """Choices with every candidate of the bundle that agrees, or without one."""
        b = self.bundles[level]
        theirs = [d for d in b.determinants if d != self.source]
        found, on = self.candidates(level), F.lit(True)
        if self.source in b.determinants:
            found = found.withColumnRenamed("__source", "__s")
            on = F.col("__source") == F.col("__s")
        else:
            keys = [*(F.col(g).alias(f"__g_{g}") for g in self.group), *(f"__d_{d}" for d in theirs), *(F.col(f"{b.name}.fields.{f}").alias(f"__l_{f}") for f in self.wanted_later(level))]
            found = self.belongs.join(found, "__source").groupBy(*keys).agg(F.max(b.name).alias(b.name))
            for g in self.group:
                on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
        for d in theirs:
            first = next(x for x in self.bundles if d in x.fields)
            on = on & F.col(f"{first.name}.fields.{d}").eqNullSafe(F.col(f"__d_{d}"))
        rows = choices.join(found, on, "left")
        trust = self.plus(F.col("__trust"), {level: F.coalesce(F.col(f"{b.name}.trust"), self.empty(level))})
        return rows.select(*(c for c in choices.columns if c != "__trust"), b.name, trust.alias("__trust"))

    def best(self, choices: DataFrame, level: int) -> DataFrame:
        """The most promising choice of each group; of those that tie the one with the greatest fields."""
        kept = [c for c in choices.columns if c not in self.group]
        top = F.max(F.struct(self.bound(level).alias("__bound"), *(b.name for b in self.bundles[: level + 1]), *(c for c in kept if c not in {b.name for b in self.bundles})))
        return choices.groupBy(*self.group).agg(top.alias("__top")).select(*self.group, *(F.col(f"__top.{c}").alias(c) for c in kept))


def consistent_survivors(members: DataFrame, group: list[str], source: str, records: DataFrame, bundles: list[Bundle]) -> DataFrame:
    """One row per group with the fields of the choice of greatest trust; a bundle without a candidate that agrees has nulls.

    ``members``: (group columns, source), repeated rows count once; ``records`` holds rows per source. A group of which
    no record is usable for the first bundle gives no row. Choices that tie in trust are told apart by their fields, bundle by
    bundle, the greatest first; fields that several bundles have are those of the first. Null sources match nothing; a null in the
    group columns is a value like others; extra columns are ignored.
    """
    cut, names = Scratch(members.sparkSession, "survivors"), group
    # one column that is never null
    members, group = members.select(F.struct(*group).alias("__g"), F.col(f"`{source}`")), ["__g"]
    search = _Search(members, group, source, records, bundles, cut)
    opened, last = search.start(), len(bundles) - 1
    if last:
        # what can be had is kept with the choice, so that each level only looks at its own rows
        had = cut.cut(opened.groupBy(*group).agg(F.max(search.at_least(0)).alias("__had")))
        opened = cut.cut(spread_join(opened, had, group).where(search.bound(0) >= F.col("__had")))
        if opened.count() > had.count():
            dive = search.best(opened.drop("__had"), 0)
            for level in range(1, len(bundles)):
                dive = search.best(search.extended(cut.cut(dive), level), level)
            had = cut.cut(dive.select(*group, F.col("__trust").alias("__had")))
            opened = cut.cut(spread_join(opened.drop("__had"), had, group).where(search.bound(0) >= F.col("__had")))
        for level in range(1, len(bundles)):
            opened = cut.cut(search.extended(opened, level).where(search.bound(level) >= F.col("__had")))
    best = search.best(opened, last)
    first_in = {f: b.name for b in reversed(bundles) for f in b.fields}
    return best.select(*(F.col(f"__g.{n}").alias(n) for n in names), *(F.col(f"{first_in[f]}.fields.{f}").alias(f) for b in bundles for f in b.fields if first_in[f] == b.name and f not in names))
