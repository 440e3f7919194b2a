"""Preprocessing pipelines (F14, F15): impute -> zero-as-missing + median -> encode -> scale
-> features -> split, as one lazy plan after the (small, eager) fits.

Fitted state is kept in a ``Preprocessor`` so the same values can be re-applied to new data
(the reference's fitted scalers / encoders). ``fit_on="train"`` fits after the split, on the
train rows only (no test leakage); ``"all"`` (default) matches the reference.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.columns import categorical_columns, is_missing, numeric_columns
from cadence.functions.quantiles import exact_quantiles
from cadence.operators.encode import (LabelCodes, apply_categories, apply_label_codes, categories_from_counts, code_table,
                                      codes_from_counts, fit_categories, fit_label_codes, load_codes)
from cadence.operators.features import create_features
from cadence.operators.fitstate import FitState, Moments, add_sketches, fit_state, modes
from cadence.operators.impute import INTEGRAL, Imputation, apply_missing, fit_missing, zero_as_missing
from cadence.operators.scale import ScaleParams, apply_scaler, fit_scaler, load_scaler, scaler_from_moments, scaler_table
from cadence.operators.split import hash_split


def resolve_target(columns: list[str], wanted: str | None) -> str:
    """Configured name, else ``target``, else the last column."""
    if wanted and wanted in columns:
        return wanted
    if "target" in columns:
        return "target"
    return columns[-1]


@dataclass
class Preprocessor:
    missing_strategy: str = "mean"
    encoding_method: str = "label"
    scaling_method: str = "standard"
    zero_as_missing_columns: list[str] = field(default_factory=list)
    interactions: list[tuple[str, str]] | None = None
    polynomial: list[str] | None = None
    exclude_from_scaling: list[str] = field(default_factory=list)
    exact: bool = True
    fill_value: Any = None
    keys: list[str] = field(default_factory=list)   # neither imputed, encoded nor scaled
    # fitted state
    state: FitState | None = None
    columns: list[str] = field(default_factory=list)
    integral: list[str] = field(default_factory=list)
    imputation: Imputation | None = None
    zero_imputation: Imputation | None = None
    codes: LabelCodes | None = None
    categories: dict[str, list[str]] | None = None
    scaler: ScaleParams | None = None
    _source: DataFrame | None = None    # what the state was fitted on, until its sketches are wanted

    def fit(self, df: DataFrame) -> Preprocessor:
        """Fit every step on ``df``, each on what the steps before make of it. Every column gets a fill
        value, also one without a missing value here, so that later rows never keep a NULL."""
        cols = [c for c in df.columns if c not in self.keys]
        df = df.select(*cols)
        self.zero_as_missing_columns = [c for c in self.zero_as_missing_columns if c in cols]
        if self.missing_strategy in ("fill", "drop"):
            return self._fit_by_steps(df)
        num = numeric_columns(df)
        self.integral = [f.name for f in df.schema.fields if f.name in num and isinstance(f.dataType, INTEGRAL)]
        self.columns = cols if self.missing_strategy == "mode" else [c for c in cols if c in num or c in categorical_columns(df)]
        self.state = self._state_of(df)
        self._source = df
        exact = {}
        if self.exact:
            first = self._first_fills({}) if self.missing_strategy != "median" else {}
            exact = self._exact_medians(df, num if self.missing_strategy == "median" else [], first)
        self._derive(exact)
        return self

    def update(self, df: DataFrame) -> Preprocessor:
        """Extend the fit by a batch of new rows without reading the earlier ones: states add up. Means, modes,
        codes and the scaler are those of all rows together; medians are to the precision of the sketch."""
        if self.state is None:
            raise RuntimeError("only a preprocessor fitted with mean, median or mode can be updated")
        df = df.select(*self.columns)
        self.state = self._sketched().merge(add_sketches(self._state_of(df), df, self._sketch_columns()))
        self._derive({})
        return self

    def _state_of(self, df: DataFrame) -> FitState:
        cat = categorical_columns(df)
        return fit_state(df, self.zero_as_missing_columns, [c for c in df.columns if c not in cat] if self.missing_strategy == "mode" else [])

    def _sketch_columns(self) -> list[str]:
        """Columns whose median may be wanted."""
        return list(self.state.numbers) if self.missing_strategy == "median" else self.zero_as_missing_columns

    def _sketched(self) -> FitState:
        """The state with its sketches, which an exact fit does without until it is saved or updated."""
        columns = [c for c in self._sketch_columns() if self.state.numbers[c].sketch is None]
        return add_sketches(self.state, self._source, columns) if columns else self.state

    def _exact_medians(self, df: DataFrame, columns: list[str], fills: dict[str, Any]) -> dict[tuple, float]:
        """{(step, column): median}: of ``columns`` (step 0), and of the zero-as-missing columns once NULLs are
        filled and zeros taken out (step 1), both in one pair of scans where the fill is known."""
        def medians(exprs: dict[str, Any]) -> dict[str, float]:
            if not exprs:
                return {}
            rows = exact_quantiles(df.select(*[e.alias(k) for k, e in exprs.items()]), list(exprs), [0.5]).collect()
            return {r["column"]: r["quantiles"][0] for r in rows}  # one row a column

        def filled(c):
            fill = fills.get(c)
            x = F.when(~is_missing(df, c), F.col(c).cast("double"))
            return F.nullif(x if fill is None else F.coalesce(x, F.lit(float(fill))), F.lit(0.0))

        names = {f"m{i}": (0, c) for i, c in enumerate(columns)}
        zeros = {f"z{i}": (1, c) for i, c in enumerate(self.zero_as_missing_columns)}
        first = {k: F.col(c).cast("double") for k, (_, c) in names.items()}
        if columns and any(self.state.numbers[c].missing for _, c in zeros.values()):
            got = medians(first)  # the fills of NULLs are needed before zeros can be filled
            fills = {c: got.get(k) for k, (_, c) in names.items()}
            got |= medians({k: filled(c) for k, (_, c) in zeros.items()})
        else:
            got = medians(first | {k: filled(c) for k, (_, c) in zeros.items()})
        return {at: got[k] for k, at in (names | zeros).items() if k in got}

    def _first_fills(self, exact: dict[tuple, float]) -> dict[str, Any]:
        """Fill values of missing values: numbers by the strategy, the others by their mode."""
        numbers, names = self.state.numbers, list(self.state.missing)
        if self.missing_strategy == "mode":
            found = modes(self.state, self.columns)
            fills = {c: float(v) if c in numbers else v for c, v in found.items()}
            return {c: 0 if self.fill_value is None else self.fill_value for c in [*numbers, *names]} | fills
        found = modes(self.state, names)
        fills = {c: found.get(c, "unknown") for c in names}
        if self.missing_strategy == "mean":
            return fills | {c: s.all.mean if s.present else None for c, s in numbers.items()}
        # The sketches of zero-as-missing columns are without the zeros, which still count here.
        zeros = {c: (numbers[c].zeros, 0.0) for c in self.zero_as_missing_columns}
        sketched = {} if all((0, c) in exact for c, s in numbers.items() if s.present) else self._sketched().medians(zeros)
        return fills | {c: exact.get((0, c), sketched.get(c)) for c in numbers}

    def _derive(self, exact: dict[tuple, float]) -> None:
        """Fill values, codes and scaler from the state; ``exact`` has medians that are known exactly."""
        fills, numbers = self._first_fills(exact), self.state.numbers
        widen = [c for c in self.integral if self.missing_strategy != "mode" and fills[c] is not None]
        self.imputation, zeros = Imputation(self.missing_strategy, fills, widen), self.zero_as_missing_columns
        second: dict[str, Any] = {}
        if zeros:
            constants = {c: (numbers[c].missing, float(fills[c])) for c in zeros if fills[c]}
            sketched = {} if all((1, c) in exact for c in zeros) else self._sketched().medians(constants)
            second = {c: exact.get((1, c), sketched.get(c)) for c in zeros}
            self.zero_imputation = Imputation("median", second, [c for c in zeros if c in self.integral and c not in widen])
        moments = {}
        for c, s in numbers.items():
            null, zero = s.missing, s.zeros
            if c not in zeros:
                moments[c] = s.all.merge(Moments.constant(null if fills[c] is not None else 0, fills[c] or 0.0))
                continue
            if fills[c] == 0:
                null, zero = 0, zero + null
            kept = s.nonzero.merge(Moments.constant(null if fills[c] is not None else 0, fills[c] or 0.0))
            moments[c] = kept.merge(Moments.constant(zero if second[c] is not None else 0, second[c] or 0.0))
        if self.encoding_method == "label":
            self.codes, of_codes = codes_from_counts(self.state.values, {c: (fills[c], n) for c, n in self.state.missing.items()},
                                                     self.state.heads())
            moments |= {c: Moments(*m) for c, m in of_codes.items()}
        else:
            self.categories = categories_from_counts(self.state.values, {c: (fills[c], n) for c, n in self.state.missing.items()})
        self.scaler = scaler_from_moments({c: moments[c] for c in self.columns if c in moments and c not in self.exclude_from_scaling},
                                          self.scaling_method)

    def _fit_by_steps(self, df: DataFrame) -> Preprocessor:
        """For constant fills and dropped rows, whose moments do not add up by column: every step reads
        what the one before made."""
        self.imputation = fit_missing(df, self.missing_strategy, self.fill_value)
        df = apply_missing(df, self.imputation)
        if self.zero_as_missing_columns:
            df = zero_as_missing(df, self.zero_as_missing_columns)
            self.zero_imputation = fit_missing(df, "median", exact=self.exact, columns=self.zero_as_missing_columns, only_missing=False)
            df = apply_missing(df, self.zero_imputation)
        if self.encoding_method == "label":
            self.codes = fit_label_codes(df)
            df = apply_label_codes(df, self.codes)
        else:
            self.categories = fit_categories(df)
            df = apply_categories(df, self.categories)
        self.scaler = fit_scaler(df, method=self.scaling_method, exclude=self.exclude_from_scaling)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Apply the fitted values, to the frame they came from or to new data (F06, F09):
        nothing is fitted again."""
        if self.imputation is None:
            raise RuntimeError("Preprocessor is not fitted")
        df = apply_missing(df, self.imputation)
        if self.zero_imputation is not None:
            df = apply_missing(zero_as_missing(df, self.zero_as_missing_columns), self.zero_imputation)
        df = apply_label_codes(df, self.codes) if self.codes else apply_categories(df, self.categories or {})
        df = apply_scaler(df, self.scaler)
        if self.interactions or self.polynomial:
            df = create_features(df, self.interactions, self.polynomial)
        return df

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def save(self, spark, path: str) -> None:
        """Fitted label codes and scaler as tables under ``path``, fill values as JSON rows."""
        code_table(self.codes or LabelCodes(), spark).write.mode("overwrite").parquet(f"{path}/codes")
        scaler_table(self.scaler, spark).write.mode("overwrite").parquet(f"{path}/scaler")
        if self.state:
            self._sketched().write(f"{path}/fit")
        state = {"missing": asdict(self.imputation), "fitted": self.state is not None, "zero": asdict(self.zero_imputation) if self.zero_imputation else None,
                 "categories": self.categories, "settings": {k: getattr(self, k) for k in (
                     "missing_strategy", "encoding_method", "scaling_method", "zero_as_missing_columns", "interactions",
                     "polynomial", "exclude_from_scaling", "exact", "fill_value", "keys", "columns", "integral")}}
        spark.createDataFrame([(json.dumps(state),)], "state string").write.mode("overwrite").parquet(f"{path}/state")

    @classmethod
    def load(cls, spark, path: str) -> Preprocessor:
        state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        out = cls(**state["settings"])
        out.imputation = Imputation(**state["missing"])
        out.zero_imputation = Imputation(**state["zero"]) if state["zero"] else None
        out.categories = state["categories"]
        if out.encoding_method == "label":
            out.codes = load_codes(spark.read.parquet(f"{path}/codes"))
        out.state = FitState.read(spark, f"{path}/fit") if state["fitted"] else None
        out.scaler = load_scaler(spark.read.parquet(f"{path}/scaler"), out.scaling_method)
        return out


def run_pipeline(df: DataFrame, config: dict[str, Any] | None = None,
                 output_path: str | None = None) -> DataFrame:
    """impute -> encode -> scale -> optional features; optionally written as Parquet."""
    config = config or {}
    fc = config.get("feature_config") or {}
    pre = Preprocessor(missing_strategy=config.get("missing_strategy", "mean"),
                       encoding_method=config.get("encoding_method", "label"),
                       scaling_method=config.get("scaling_method", "standard"), fill_value=config.get("fill_value"),
                       interactions=fc.get("interactions"), polynomial=fc.get("polynomial"),
                       exclude_from_scaling=config.get("exclude_from_scaling", []))
    out = pre.fit_transform(df)
    if output_path:
        out.write.mode("overwrite").parquet(output_path)
    return out


def prepare(df: DataFrame, key: str | list[str], target: str | None = None,
            test_size: float = 0.15, val_size: float = 0.15, seed: int = 42,
            zero_as_missing_columns: list[str] | None = None, scale_target: bool = False,
            exact_split: bool = False, fit_on: str = "all", config: dict | None = None):
    """returns (prepared DataFrame with ``split``, target column, fitted Preprocessor).

    Rows are split by their raw key, which no step changes, so a row keeps its split when data
    are added. ``fit_on="train"`` fits on the train rows only; what the other rows get are the
    fitted values. The target is kept as the last column (S13). ``scale_target=False`` keeps
    the target out of scaling (the reference scales it; see README decisions).
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    config = config or {}
    tgt = resolve_target(df.columns, target)
    keys = [key] if isinstance(key, str) else list(key)
    fc = config.get("feature_config") or {}
    pre = Preprocessor(missing_strategy=config.get("missing_strategy", "mean"),
                       encoding_method=config.get("encoding_method", "label"),
                       scaling_method=config.get("scaling_method", "standard"),
                       zero_as_missing_columns=zero_as_missing_columns or [], fill_value=config.get("fill_value"),
                       interactions=fc.get("interactions"), polynomial=fc.get("polynomial"),
                       exclude_from_scaling=[] if scale_target else [tgt], keys=[*keys, "split"])
    split = hash_split(df, key, test_size, val_size, seed, exact=exact_split)
    pre.fit(split.where(F.col("split") == "train") if fit_on == "train" else df)
    out = pre.transform(split)
    feats = [c for c in out.columns if c not in (tgt, "split")]
    return out.select(*feats, "split", tgt), tgt, pre


def prepare_path(spark, source: str, output: str, key: str | list[str], **settings) -> dict:
    """F15 from a data path to written splits (S11 -> F15 -> S13): paths and row counts of train,
    val and test, and the fitted preprocessor saved beside them."""
    from cadence.sources.readers import load_training_data
    from cadence.sources.sinks import write_splits
    out, tgt, pre = prepare(load_training_data(spark, source), key, **settings)
    paths = write_splits(out, f"{output}/splits", tgt)
    pre.save(spark, f"{output}/preprocessor")
    counts = {r["split"]: r["count"] for r in spark.read.parquet(f"{output}/splits").groupBy("split").count().collect()}
    return {"target": tgt, "paths": paths, "counts": {k: counts.get(k, 0) for k in paths}, "preprocessor": f"{output}/preprocessor"}


def drop_target_marker(df: DataFrame, target: str, marker: int = -1) -> DataFrame:
    """Drop rows whose target equals the 'no label' marker (-1)."""
    return df.where(F.col(target).isNull() | (F.col(target) != marker))


def training_types(df: DataFrame, target: str | None = None) -> DataFrame:
    """P03 + P10: target = given column or the last one; features cast to float, target to
    bigint (truncating toward zero, as a float -> int64 cast does); target kept last."""
    tgt = target or df.columns[-1]
    feats = [c for c in df.columns if c != tgt]
    return df.select(*[F.col(c).cast("float").alias(c) for c in feats],
                     F.col(tgt).cast("double").cast("bigint").alias(tgt))
