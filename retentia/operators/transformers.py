"""The stateless feature steps as Spark ML stages, configured with plain dictionaries.

Settings are the entries of a preprocessing configuration, so a stage can be saved with a pipeline.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer

from retentia.operators import features as f
from retentia.operators.stages import _Settings


class BinaryFlagTransformer(_Settings, Transformer):
    """settings: list of {column, operator, value, new_column}; none gives the two default flags."""

    def _transform(self, df):
        specs = self.value if self.isDefined(self.settings) and self.value else None
        if specs is None:
            return f.add_flags(df)
        return f.add_flags(df, [f.Flag(s["column"], s.get("operator", "=="), s["value"], s["new_column"]) for s in specs])


class InteractionFeatureTransformer(_Settings, Transformer):
    """settings: list of {name, type, col_a, col_b} or {name, type, columns}."""

    def _transform(self, df):
        specs = [
            f.Interaction(s["name"], s["type"], tuple(s.get("columns") or (s["col_a"], s["col_b"]))) for s in self.value
        ]
        return f.add_interactions(df, specs)


class RatioFeatureTransformer(_Settings, Transformer):
    """settings: list of {name, numerator, denominator, denominator_offset}."""

    def _transform(self, df):
        specs = [f.Ratio(s["name"], s["numerator"], s["denominator"], s.get("denominator_offset", 0)) for s in self.value]
        return f.add_ratios(df, specs)


class AgeBinTransformer(_Settings, Transformer):
    """settings: {column, new_column, bins, labels, ordinal_encoding, ordinal_map}."""

    def _transform(self, df):
        s = self.value
        ordinal = s.get("ordinal_map") if s.get("ordinal_encoding", True) else None
        return f.add_bins(df, f.Bins(s["column"], s["new_column"], tuple(s["bins"]), tuple(s["labels"]), ordinal))


def _encodings(settings):
    return [
        f.Encoding(
            s["column"], s["method"], s.get("prefix"), s.get("drop_first", False), s.get("mapping") or {},
            s.get("new_column"), tuple(s["vocabulary"]) if s.get("vocabulary") is not None else None,
        )
        for s in settings
    ]


class CategoricalEncoder(_Settings, Estimator):
    """settings: list of {column, method, prefix, drop_first, mapping, new_column}.

    One-hot vocabularies are learned in fit; a category unseen there gives all zeros later.
    """

    def _fit(self, df):
        learned = []
        for s in self.value:
            if s["method"] in ("one_hot", "one_hot_vector") and s["column"] in df.columns:
                s = {**s, "vocabulary": list(f.learn_vocabulary(df, s["column"]))}
            learned.append(s)
        return CategoricalEncoderModel(learned)


class CategoricalEncoderModel(_Settings, Model):
    def _transform(self, df):
        return f.encode(df, _encodings(self.value))
