"""Imputation, scaling and encoding as plain column expressions, with statistics fitted on train.

What a fit needs to know of its rows is measured once for all columns (`Statistics`) and shared by all candidates. A
category is a slot number: values are looked up in the learner's vocabulary, one expression per column however many
values it has, and one-hot vectors are sparse.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from arrivo.operators.quantiles import VALUE, WEIGHT, column_quantiles, quantiles_of_counts

MISSING = "unknown"
MIN_FREQUENCY = 20
POOLED = "_infrequent_"
MOST_VALUES = 10_000  # of one category: the vocabulary is part of the model
COUNTED_ROWS = 200_000  # whose values are counted in a task before the counts are handed on


def median_table(train: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Exact medians: (columna, mediana)."""
    return column_quantiles(train, numeric, [0.5], ["mediana"])


def text_of(column: str) -> Column:
    """A category as text; missing is a category of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def category_counts(train: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Rows per (columna, valor), missing counted as `unknown`."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("columna"), text_of(c).alias("valor"))
            for c in categorical
        ]
    )
    return (
        train.select(F.explode(cells).alias("cell"))
        .select("cell.*")
        .groupBy("columna", "valor")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def pooled_categories(
    train: DataFrame, categorical: Sequence[str], min_frequency: int = MIN_FREQUENCY
) -> DataFrame:
    """Category counts after pooling values rarer than `min_frequency`."""
    label = F.when(F.col("n") >= min_frequency, F.col("valor")).otherwise(POOLED)
    return (
        category_counts(train, categorical)
        .groupBy("columna", label.alias("valor"))
        .agg(F.sum("n").alias("n"))
    )


def moment_table(train: DataFrame, numeric: Sequence[str], medians: dict[str, float]) -> DataFrame:
    """Mean and population deviation after imputation: (columna, media, desvio)."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in numeric]
    wide = train.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("columna"),
                    F.avg(x).alias("media"),
                    F.stddev_pop(x).alias("desvio"),
                )
                for c, x in zip(numeric, filled)
            ]
        ).alias("m")
    )
    return wide.select(F.explode("m").alias("r")).select("r.*")


def counts_by_part(rows: DataFrame, cells: Mapping[str, Column], kind: str, parts: Mapping[str, Column]) -> DataFrame:
    """(part, columna, value, count) of all parts from one pass; a cell of NaN counts nothing.

    A row that is in several parts is handed over once, and tasks count the values of many rows at a time in arrays.
    """
    names, labels = list(cells), list(parts)
    wanted = [c.alias(f"c{i}") for i, c in enumerate(cells.values())] + [F.coalesce(m, F.lit(False)).alias(f"m{i}") for i, m in enumerate(parts.values())]
    shape = pa.schema([("part", pa.string()), ("columna", pa.string()), (VALUE, pa.float64() if kind == "double" else pa.string()), (WEIGHT, pa.int64())])

    def counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        members = [table.column(f"m{p}").to_numpy() for p in range(len(labels))]
        for i, name in enumerate(names):
            if kind == "double":
                values, codes = np.unique(table.column(f"c{i}").to_numpy(), return_inverse=True)
                told = ~np.isnan(values)
            else:
                found = table.column(f"c{i}").combine_chunks().dictionary_encode()
                values, codes = np.array(found.dictionary.to_pylist(), object), found.indices.to_numpy()
                told = np.ones(len(values), bool)
            for label, member in zip(labels, members):
                n = np.bincount(codes[member], minlength=len(values))
                met = np.flatnonzero((n > 0) & told)
                columns = [pa.array([label] * len(met), pa.string()), pa.array([name] * len(met), pa.string()), pa.array(values[met], shape.field(2).type), pa.array(n[met])]
                yield pa.RecordBatch.from_arrays(columns, schema=shape)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= COUNTED_ROWS:
                yield from counted(held)
                held = []
        if held:
            yield from counted(held)

    some = rows.select(*wanted).where(" OR ".join(f"m{p}" for p in range(len(labels))))
    found = some.mapInArrow(count, f"part string, columna string, {VALUE} {kind}, {WEIGHT} bigint")
    return found.groupBy("part", "columna", VALUE).agg(F.sum(WEIGHT).alias(WEIGHT))


@dataclass(frozen=True)
class Statistics:
    """Of a set of rows: medians, mean and deviation after imputation, category counts, rows per class."""

    medians: dict[str, float]
    moments: dict[str, tuple[float, float]]
    counts: dict[str, dict[str, int]]
    classes: dict[int, int]

    @classmethod
    def of(cls, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str | None = None) -> "Statistics":
        """Three passes over the rows; a few numbers per column and the vocabularies, which are part of the model, come back.

        A category with more than `MOST_VALUES` values is refused: it is an identifier, and would not fit the driver.
        """
        numeric, categorical = list(numeric), list(categorical)
        medians = {c: 0.0 for c in numeric}
        if numeric:
            medians |= {r["columna"]: r["mediana"] for r in median_table(train, numeric).collect()}
        moments = {r["columna"]: (r["media"], r["desvio"] or 1.0) for r in moment_table(train, numeric, medians).collect()} if numeric else {}
        # the label is counted like a category, in the same pass
        counted = [*categorical, *([label] if label else [])]
        found = category_counts(train, counted).limit(len(counted) * MOST_VALUES + 1).collect() if counted else []
        return cls.gathered(medians, moments, [(r["columna"], r["valor"], r["n"]) for r in found], counted, label)

    @classmethod
    def gathered(cls, medians, moments, found: Sequence[tuple[str, str, int]], counted: Sequence[str], label: str | None) -> "Statistics":
        """With the (column, value, rows) found of the categories and the label."""
        counts: dict[str, dict[str, int]] = {c: {} for c in counted}
        for column, value, n in sorted(found):
            counts[column][value] = n
        if wide := [c for c in counted if len(counts[c]) > MOST_VALUES]:
            raise ValueError(f"more than {MOST_VALUES} values, so no categories: {', '.join(wide)}")
        classes = {int(v): n for v, n in counts.pop(label).items() if v != MISSING} if label else {}
        return cls(medians, moments, counts, classes)

    @classmethod
    def of_parts(
        cls, rows: DataFrame, parts: Mapping[str, Column], numeric: Sequence[str], categorical: Sequence[str], label: str
    ) -> dict[str, "Statistics"]:
        """Those of every part: medians and counts of all parts come out of two passes, however much the parts overlap."""
        numeric, counted = list(numeric), [*categorical, label]
        medians = {p: {c: 0.0 for c in numeric} for p in parts}
        if numeric:
            cells = {c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in numeric}
            of_values = counts_by_part(rows, cells, "double", parts)
            for r in quantiles_of_counts(of_values, [0.5], ["part", "columna"], ["mediana"]).collect():
                medians[r["part"]][r["columna"]] = r["mediana"]
        most = len(parts) * len(counted) * MOST_VALUES + 1
        found = counts_by_part(rows, {c: text_of(c) for c in counted}, "string", parts).limit(most).collect()
        out = {}
        for part, member in parts.items():
            table = moment_table(rows.where(member), numeric, medians[part]).collect() if numeric else []
            moments = {r["columna"]: (r["media"], r["desvio"] or 1.0) for r in table}
            out[part] = cls.gathered(medians[part], moments, [(r["columna"], r[VALUE], r[WEIGHT]) for r in found if r["part"] == part], counted, label)
        return out


@dataclass
class Preprocessor:
    """Fitted statistics. `layout` is "onehot" for linear models and "ordinal" for trees."""

    numeric: list[str]
    categorical: list[str]
    layout: str = "onehot"
    min_frequency: int = 1
    medians: dict[str, float] = field(default_factory=dict)
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    rare: dict[str, list[str]] = field(default_factory=dict)

    def fit(self, train: DataFrame) -> "Preprocessor":
        return self.take(Statistics.of(train, self.numeric, self.categorical))

    def take(self, known: Statistics) -> "Preprocessor":
        """Fit from measured statistics, which may cover further columns."""
        linear = self.layout == "onehot"
        self.medians = {c: known.medians[c] for c in self.numeric}
        self.scales = {c: known.moments[c] for c in self.numeric} if linear else {}
        common = {c: {v: n for v, n in known.counts[c].items() if not linear or n >= self.min_frequency} for c in self.categorical}
        self.categories = {c: list(common[c]) for c in self.categorical}
        self.rare = {c: [v for v in known.counts[c] if v not in common[c]] for c in self.categorical}
        return self

    def codes(self, df: DataFrame) -> DataFrame:
        """Add `_code_<c>` per category: 1, 2 and so on by vocabulary, then one for pooled values; 0 if never seen."""
        known = [c for c in self.categorical if self.categories[c] or self.rare[c]]
        texts = {f"_text_{c}": text_of(c) for c in known}
        out = df.withColumns(texts) if texts else df
        if known:
            labels = [[*self.categories[c], *self.rare[c]] for c in known]
            names = [f"_text_{c}" for c in known]
            # values are found by hash, whatever their number
            finder = StringIndexerModel.from_arrays_of_labels(labels, names, [f"_at_{c}" for c in known], "keep")
            out = finder.transform(out)
        slots = {}
        for c in self.categorical:
            at, common = F.col(f"_at_{c}"), len(self.categories[c])
            every = common + len(self.rare[c])
            slots[f"_code_{c}"] = F.when(at < every, F.least(at, F.lit(float(common))) + 1).otherwise(0.0) if every else F.lit(0.0)
        drop = [name for c in known for name in (f"_text_{c}", f"_at_{c}")]
        return (out.withColumns(slots) if slots else out).drop(*drop)

    def _filled(self, c: str) -> Column:
        return F.coalesce(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), F.lit(self.medians[c]))

    def text(self, c: str) -> Column:
        return text_of(c)

    def numbers(self) -> list[Column]:
        """The numeric inputs of the model, filled and scaled as the layout asks."""
        if self.layout == "onehot":
            return [(self._filled(c) - self.scales[c][0]) / self.scales[c][1] for c in self.numeric]
        # a number and whether it was missing
        return [x for c in self.numeric for x in (self._filled(c), F.col(c).isNull().cast("double"))]

    def width(self, c: str) -> int:
        """Slots of a category in the one-hot layout."""
        return len(self.categories[c]) + bool(self.rare[c])

    def slot_metadata(self) -> dict:
        """Marks the coded columns of the ordinal layout as categories for the tree learner."""
        names = [n for c in self.numeric for n in (c, f"{c}_falta")]
        numeric = [{"idx": i, "name": n} for i, n in enumerate(names)]
        nominal = [
            {"idx": len(names) + i, "name": c, "vals": [POOLED, *self.categories[c]]}
            for i, c in enumerate(self.categorical)
        ]
        attrs = {"numeric": numeric, "nominal": nominal} if nominal else {"numeric": numeric}
        return {"ml_attr": {"attrs": attrs, "num_attrs": len(numeric) + len(nominal)}}

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Add the feature vector; a value never seen in training has all zeros in the one-hot layout."""
        coded, numbers = self.codes(df), self.numbers()
        codes = [f"_code_{c}" for c in self.categorical]
        if self.layout == "ordinal":
            vector = array_to_vector(F.array(*numbers, *[F.col(c) for c in codes]))
            return coded.withColumn(out, vector).drop(*codes)
        parts = []
        if numbers:
            # the declared size spares the assembler a look at the rows, which a stream does not allow
            sized = {"ml_attr": {"num_attrs": len(numbers)}}
            coded = coded.withColumn("_numbers", array_to_vector(F.array(*numbers)).alias("_numbers", metadata=sized))
            parts.append("_numbers")
        hot = [c for c in self.categorical if self.width(c)]
        if hot:
            # the encoder leaves out the last slot, which the code of unseen values is turned into
            slots = {}
            for c in hot:
                slot = F.when(F.col(f"_code_{c}") > 0, F.col(f"_code_{c}") - 1).otherwise(float(self.width(c)))
                nominal = {"type": "nominal", "num_vals": self.width(c) + 1, "name": c}
                slots[c] = slot.alias(f"_slot_{c}", metadata={"ml_attr": nominal})
            coded = coded.select("*", *slots.values())
            encoder = OneHotEncoder(inputCols=[f"_slot_{c}" for c in hot], outputCols=[f"_hot_{c}" for c in hot], dropLast=True)
            coded = encoder.fit(coded).transform(coded)  # sizes come from the metadata: no pass over the rows
            parts += [f"_hot_{c}" for c in hot]
        joined = VectorAssembler(inputCols=parts, outputCol=out).transform(coded)
        return joined.drop(*parts, *codes, *[f"_slot_{c}" for c in hot])

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, data: dict) -> "Preprocessor":
        data = dict(data)
        data["scales"] = {k: tuple(v) for k, v in data["scales"].items()}
        return cls(**data)
