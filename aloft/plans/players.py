"""Subscriber classifier (Q22-Q30)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aloft.constants import LOGISTIC_MAX_ITER, SPLIT_SEED, SPLIT_WEIGHTS
from aloft.operators import ml
from aloft.schemas import PLAYER_FEATURES
from aloft.session import saved
from aloft.sources import read_players


class PlayerModel:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    # Q22
    def convert(self, path: str) -> DataFrame:
        return read_players(self.spark, path)

    # Q23
    def indexer(self, df: DataFrame) -> DataFrame:
        return ml.index_categories(df, "country", "country_index")

    # Q24: the documented nine features (label excluded)
    def feature_assembler(self, df: DataFrame, input_cols: list[str] | None = None) -> DataFrame:
        return ml.assemble(df, input_cols or PLAYER_FEATURES, "features")

    # Q25
    def scaler(self, df: DataFrame, output_col: str) -> DataFrame:
        return ml.scale(df, output_col, "features")

    # Q26
    def create_model(self, training: DataFrame, features_col: str, label_col: str,
                     pred_col: str):
        return ml.fit_logistic(training, features_col, label_col, pred_col,
                               max_iter=LOGISTIC_MAX_ITER)

    # Q27
    def predict(self, model, data: DataFrame) -> DataFrame:
        return ml.predict(model, data)

    # Q28-Q30: convert -> index -> assemble -> scale -> split -> fit -> predict -> evaluate
    def run(self, path: str, seed: int = SPLIT_SEED, split_key: str | None = None) -> dict:
        # the fits and the solver's iterations read the parsed rows, not the raw lines
        rows = saved(self.convert(path), "players")
        scaled = self.scaler(self.feature_assembler(self.indexer(rows)), "scaledFeatures")
        if split_key:
            train, test = ml.hash_split(scaled, split_key, SPLIT_WEIGHTS[0], seed)
        else:
            train, test = ml.random_split(scaled, SPLIT_WEIGHTS, seed)
        model = self.create_model(train, "scaledFeatures", "paid_customer", "prediction")
        return ml.evaluate(self.predict(model, test), "paid_customer")

    # Original method names.
    def featureAssembler(self, df: DataFrame) -> DataFrame:  # noqa: N802
        return self.feature_assembler(df)

    def createModel(self, training: DataFrame, featuresCol: str, labelCol: str,  # noqa: N802,N803
                    predCol: str):  # noqa: N803
        return self.create_model(training, featuresCol, labelCol, predCol)
