"""Preparation, training, evaluation and explanation."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.catalog.base import query, rounded
from holdfast.operators import neighbours, quantiles, rates
from holdfast.operators.selection import segment_filter
from holdfast.plans import explain, features, metrics, models, oversample
from holdfast.session import scratch_path
from holdfast.sources import artifacts

#: Reference points of sampled attributions.
BACKGROUND_ROWS = 4


def complete_view(src) -> DataFrame:
    """The view with missing total charges filled at the source."""
    from holdfast.operators.view360 import customer_360

    return customer_360(src.crm, src.services, quantiles.fill_median(src.billing, "total_charges"), src.cdr)


def matrix(src) -> DataFrame:
    return features.model_matrix(features.add_derived_features(complete_view(src)))


def label_keys(src) -> DataFrame:
    """Customers that the view holds, so that shares of a split are shares of its rows, and their label. No wide row is read."""
    labels = src.billing.select("customer_id", F.when(F.col("churn") == "Yes", 1).otherwise(0).alias("label"))
    for other in (src.crm, src.services):
        labels = labels.join(other.select("customer_id"), "customer_id", "left_semi")
    return labels


def split_matrix(src) -> DataFrame:
    return features.stratified_split(matrix(src), keys=label_keys(src))


@dataclass
class Trained:
    """Everything fitted on one data folder. The prepared rows are stored once and read back by each step."""

    src: object

    @cached_property
    def split(self) -> DataFrame:
        path = scratch_path(self.src.spark, "matrix")
        split_matrix(self.src).write.parquet(path)
        return self.src.spark.read.parquet(path)

    @property
    def train(self) -> DataFrame:
        return self.split.filter(F.col("split") == "train")

    @cached_property
    def preprocessor(self) -> PipelineModel:
        return features.build_preprocessor(self.train).fit(self.train)

    @cached_property
    def names(self) -> list[str]:
        return features.feature_names(self.preprocessor)

    @cached_property
    def prepared(self) -> DataFrame:
        path = artifacts.features_write(
            features.apply_preprocessor(self.preprocessor, self.split), scratch_path(self.src.spark, "features")
        )
        return artifacts.features_read(self.src.spark, path)

    @cached_property
    def balanced(self) -> DataFrame:
        path = scratch_path(self.src.spark, "balanced")
        oversample.smote(self.prepared.filter(F.col("split") == "train")).write.parquet(path)
        return self.src.spark.read.parquet(path)

    @cached_property
    def partitions(self) -> int:
        return models.training_partitions(self.balanced.count())

    @cached_property
    def logistic(self):
        return models.fit_logistic(self.balanced, partitions=self.partitions)

    @cached_property
    def boosted(self):
        return models.fit_boosted(self.balanced, partitions=self.partitions)

    @cached_property
    def test(self) -> DataFrame:
        return self.prepared.filter(F.col("split") == "test")

    @cached_property
    def runs(self) -> DataFrame:
        """Both models, logged with their settings, area under the curve on the test rows, and where they are saved."""
        path = scratch_path(self.src.spark, "runs")
        for name, model, params in (
            ("logistic_regression", self.logistic, models.LOGISTIC), ("boosted_trees", self.boosted, models.BOOSTED),
        ):
            scored = models.score_customers(model, self.test)
            auc = metrics.roc_auc(scored, "label", "churn_probability").first()[0]
            saved = models.save_model(model, scratch_path(self.src.spark, name))
            models.log_run(self.src.spark, path, name, {**params, "partitions": self.partitions}, auc, saved)
        return models.read_runs(self.src.spark, path)

    @cached_property
    def winner(self):
        """The model of the better run, loaded from where the log says it is."""
        best = metrics.model_compare(self.runs).filter("best").select("run_name")
        run = self.runs.join(best, "run_name").first()
        kind = type(self.logistic if run["run_name"] == "logistic_regression" else self.boosted)
        return kind.load(run["model_path"])

    @cached_property
    def attributions(self) -> DataFrame:
        """Of the winner: closed form if it is linear, else sampled."""
        if isinstance(self.winner, LogisticRegressionModel):
            means = explain.feature_means(self.balanced, self.names)
            phi = explain.linear_attribution(self.test, list(self.winner.coefficients), means, self.names)
        else:
            background = explain.background_rows(self.prepared.filter(F.col("split") == "train"), BACKGROUND_ROWS)
            phi = explain.sampled_shapley(self.winner, self.test, background, self.names)
        path = artifacts.attributions_write(phi, scratch_path(self.src.spark, "attributions"))
        return self.src.spark.read.parquet(path)

    @cached_property
    def base_value(self) -> float:
        if isinstance(self.winner, LogisticRegressionModel):
            means = explain.feature_means(self.balanced, self.names)
            return float(self.winner.intercept + sum(b * m for b, m in zip(self.winner.coefficients, means)))
        background = explain.background_rows(self.prepared.filter(F.col("split") == "train"), BACKGROUND_ROWS)
        return explain.base_value(self.winner, self.src.spark, background)


_TRAINED: dict[tuple[str, str], Trained] = {}


def trained(src) -> Trained:
    key = (src.spark.sparkContext.applicationId, src.folder)
    if key not in _TRAINED:
        _TRAINED[key] = Trained(src)
    return _TRAINED[key]


# --- preparation -------------------------------------------------------------------------------------------------

_BAND = "case when tenure <= 12 then 0 when tenure <= 36 then 1 when tenure <= 60 then 2 else 3 end"


@query("derived_features", f"""select customer_id, {_BAND} tenure_band, num_services,
    round(monthly_charges / (total_charges + 1), 6) charge_per_month_ratio, revenue_at_risk from c360""")
def _(src):
    derived = features.add_derived_features(src.view)
    return rounded(
        derived.select("customer_id", "tenure_band", "num_services", "charge_per_month_ratio", "revenue_at_risk"),
        "charge_per_month_ratio",
    )


_NUMERIC = ", ".join(c if c != "charge_per_month_ratio" else f"round({c}, 6) {c}" for c in S.NUMERIC_COLUMNS)
_NOMINAL = ", ".join(S.NOMINAL_COLUMNS)


@query("model_matrix_cols", f"select customer_id, label, {_NUMERIC}, {_NOMINAL} from model")
def _(src):
    return rounded(matrix(src), "charge_per_month_ratio")


@query("stratified_split", "select customer_id, label, split from split_rows")
def _(src):
    return features.stratified_split(label_keys(src))


@query("hashed_split")
def _(src):
    return features.hashed_split(label_keys(src))


@query("split_audit", "select split, count(*) as rows, round(avg(label), 6) churn_rate from split_rows group by split")
def _(src):
    return rounded(features.split_audit(features.stratified_split(label_keys(src))), "churn_rate")


_Z = ", ".join(
    f"round((cast({c} as double) - (select avg(cast({c} as double)) from split_rows where split = 'train')) / "
    f"(select stddev_pop(cast({c} as double)) from split_rows where split = 'train'), 6) {c}" for c in S.NUMERIC_COLUMNS)


@query("standard_scale", f"select customer_id, split, {_Z} from split_rows")
def _(src):
    split = trained(src).split
    scaled = features.standard_scale(split, split.filter(F.col("split") == "train"))
    return rounded(scaled.select("customer_id", "split", *S.NUMERIC_COLUMNS), *S.NUMERIC_COLUMNS)


@query("one_hot", " union all ".join(f"""select customer_id, '{c}_' || category feature,
    case when coalesce({c}, 'None') = category then 1 else 0 end as value from split_rows,
    (select distinct coalesce({c}, 'None') category from split_rows where split = 'train')""" for c in S.NOMINAL_COLUMNS))
def _(src):
    split = trained(src).split
    return features.one_hot(split, split.filter(F.col("split") == "train"))


@query("feature_names", f""", named as ({' union all '.join(
    f"select {i} part, '' category, '{c}' as name" for i, c in enumerate(S.NUMERIC_COLUMNS))} union all {' union all '.join(
    f"select distinct {100 + i}, coalesce({c}, 'None'), '{c}_' || coalesce({c}, 'None') from split_rows where split = 'train'"
    for i, c in enumerate(S.NOMINAL_COLUMNS))})
    select cast(row_number() over (order by part, category) - 1 as int) idx, name from named""")
def _(src):
    t = trained(src)
    path = artifacts.names_write(
        features.feature_name_table(t.preprocessor, t.split), scratch_path(src.spark, "names")
    )
    return artifacts.names_read(src.spark, path)


# The feature vector of each customer as a list: scaled numbers, then 0/1 per category of the training rows.
_VECTORS = """, vectors as (select customer_id, label, split, [{scaled}] || {hot} x from split_rows) """.format(
    scaled=", ".join(
        f"(cast({c} as double) - (select avg(cast({c} as double)) from split_rows where split = 'train')) / "
        f"(select stddev_pop(cast({c} as double)) from split_rows where split = 'train')" for c in S.NUMERIC_COLUMNS),
    hot=" || ".join(
        f"list_transform((select list_sort(list(distinct coalesce({c}, 'None'))) from split_rows where split = 'train'), "
        f"lambda k: case when coalesce({c}, 'None') = k then 1.0::double else 0.0::double end)" for c in S.NOMINAL_COLUMNS),
)
_UNNESTED = "cast(unnest(range(len(x))) as int) idx, round(unnest(x), 6) as value"


def long_vectors(df: DataFrame, *kept: str) -> DataFrame:
    """One row per customer and position of the feature vector."""
    exploded = df.select(*kept, F.posexplode(vector_to_array("features")).alias("idx", "value"))
    return rounded(exploded, "value")


@query("preprocess_fit", _VECTORS + f"select customer_id, label, split, {_UNNESTED} from vectors")
def _(src):
    t = trained(src)
    return long_vectors(features.apply_preprocessor(t.preprocessor, t.split), "customer_id", "label", "split")


@query("preprocess_saved", _VECTORS + f"select customer_id, label, split, {_UNNESTED} from vectors")
def _(src):
    """The fitted preprocessor saved, loaded and applied."""
    t = trained(src)
    loaded = models.load_preprocessor(models.save_model(t.preprocessor, scratch_path(src.spark, "preprocessor")))
    return long_vectors(features.apply_preprocessor(loaded, t.split), "customer_id", "label", "split")


@query("transformer_save_load")
def _(src):
    """Save the fitted preprocessor and the better model, load both, transform with the loaded ones."""
    t = trained(src)
    path = models.save_model(t.preprocessor, scratch_path(src.spark, "preprocessor"))
    model_path = models.save_model(t.winner, scratch_path(src.spark, "model"))
    prepared = features.apply_preprocessor(models.load_preprocessor(path), t.split)
    return models.score_customers(type(t.winner).load(model_path), prepared)


@query("features_write", _VECTORS + "select customer_id, label, split, cast(len(x) as int) width from vectors")
def _(src):
    t = trained(src)
    path = artifacts.features_write(
        features.apply_preprocessor(t.preprocessor, t.split), scratch_path(src.spark, "features-out")
    )
    return artifacts.features_read(src.spark, path).select(
        "customer_id", "label", "split", F.size(vector_to_array("features")).alias("width")
    )


@query("features_read", _VECTORS + f"select customer_id, label, {_UNNESTED} from vectors where split = 'train'")
def _(src):
    return long_vectors(trained(src).prepared.filter(F.col("split") == "train"), "customer_id", "label")


# --- balance -----------------------------------------------------------------------------------------------------


@query("minority_knn", """select a.vec_id, a.label, cast(rank as int) as rank, b neighbour_id, round(d, 6) distance from (
    select a.vec_id, a.label, b.vec_id b, list_distance(a.embedding::double[], b.embedding::double[]) d,
        row_number() over (partition by a.vec_id order by
            list_distance(a.embedding::double[], b.embedding::double[]), b.vec_id) as rank
    from embeddings a join embeddings b on a.label = b.label and a.vec_id <> b.vec_id) a where rank <= 5""")
def _(src):
    near = neighbours.nearest_neighbours(src.raw("embeddings"), 5, "vec_id", "label", "embedding")
    return rounded(neighbours.neighbour_table(near, "vec_id", "label"), "distance")


@query("smote", _VECTORS + f""", train as (select * from vectors where split = 'train'),
    sizes as (select label, count(*) n from train group by label),
    need as (select arg_min(label, n) small, (max(n) - min(n)) // min(n) each, (max(n) - min(n)) % min(n) extra from sizes),
    pts as (select customer_id, x, row_number() over (order by md5(customer_id || '|42'), customer_id) pos from train
        where label = (select small from need)),
    near as (select a.customer_id, b.x bx, row_number() over (partition by a.customer_id
        order by list_distance(a.x, b.x), b.customer_id) nth from pts a join pts b on a.customer_id <> b.customer_id),
    lists as (select customer_id, list(bx order by nth) nx from near where nth <= 5 group by customer_id),
    numbered as (select customer_id, x, nx, unnest(range(1, 1 + each + case when pos <= extra then 1 else 0 end)) number
        from pts join lists using (customer_id), need),
    digests as (select *, md5(customer_id || '|' || number || '|42') d from numbered),
    draws as (select *, nx[1 + cast('0x' || d[1:8] as bigint) % len(nx)] b, cast('0x' || d[9:16] as bigint) / 4294967296.0::double u
        from digests),
    balanced as (select customer_id, label, false synthetic, x from train union all
        select customer_id || '#' || number, (select small from need), true,
            list_transform(range(1, len(x) + 1), lambda i: x[i] + u * (b[i] - x[i])) from draws)
    select customer_id, label, synthetic, {_UNNESTED} from balanced""")
def _(src):
    return long_vectors(trained(src).balanced, "customer_id", "label", "synthetic")


@query("balance_audit", """, sizes as (select label, count(*) n from split_rows where split = 'train' group by label)
    select 'before' stage, label, n as rows from sizes union all select 'after', label, max(n) over () from sizes""")
def _(src):
    t = trained(src)
    return oversample.balance_audit(t.prepared.filter(F.col("split") == "train"), t.balanced)


@query("class_weights", """select label, count(*) as rows, round(sum(count(*)) over () / (2 * count(*)), 6) weight
    from split_rows where split = 'train' group by label""")
def _(src):
    split = features.stratified_split(label_keys(src))
    return rounded(oversample.class_weights(split.filter(F.col("split") == "train")), "weight")


# --- models ------------------------------------------------------------------------------------------------------


@query("logistic_model")
def _(src):
    """Names and coefficients of the fitted model."""
    t = trained(src)
    rows = list(zip(t.names, [float(b) for b in t.logistic.coefficients]))
    return src.spark.createDataFrame([*rows, ("intercept", float(t.logistic.intercept))], "feature string, weight double")


@query("boosted_model")
def _(src):
    t = trained(src)
    rows = list(zip(t.names, [float(b) for b in t.boosted.featureImportances.toArray()]))
    return src.spark.createDataFrame(rows, "feature string, importance double")


@query("score_customers")
def _(src):
    t = trained(src)
    return models.score_customers(t.winner, t.prepared)


@query("scores_write", """select customer_id, churn_score / 100.0::double churn_probability,
    case when churn_score > 50 then 1 else 0 end prediction from billing""")
def _(src):
    """Round trip of a score table, with the recorded churn score as score."""
    scored = src.billing.select("customer_id", (F.col("churn_score") / F.lit(100.0)).alias("churn_probability"))
    scored = scored.withColumn("prediction", F.when(F.col("churn_probability") > 0.5, 1).otherwise(0))
    return src.spark.read.parquet(artifacts.scores_write(scored, scratch_path(src.spark, "scores")))


@query("high_risk_scored")
def _(src):
    """The stored scores of the better model, joined to the view and filtered as on the page."""
    t = trained(src)
    path = artifacts.scores_write(models.score_customers(t.winner, t.prepared), scratch_path(src.spark, "model-scores"))
    joined = rates.join_scores(src.view, src.spark.read.parquet(path))
    return rates.high_risk_customers(segment_filter(joined, contracts=["Month-to-month", "One year"]))


@query("run_log")
def _(src):
    return trained(src).runs.select("run_name", "params", "roc_auc", "model_path", "ts")


# --- evaluation --------------------------------------------------------------------------------------------------


def rated(src) -> DataFrame:
    """Label, score and prediction from the recorded churn score, which needs no model."""
    return src.billing.select(
        F.col("churn_value").alias("label"), (F.col("churn_score") / F.lit(100.0)).alias("score"),
        F.when(F.col("churn_score") > 50, 1).otherwise(0).alias("prediction"),
    )


_RATED = """, rated as (select churn_value as label, churn_score / 100.0::double score,
    case when churn_score > 50 then 1 else 0 end prediction from billing) """
_AUC = """(select sum(r) from (select rank() over (order by {s}) + (count(*) over (partition by {s}) - 1) / 2.0::double r, label
    from {t}) where label = 1)"""


def _auc(table: str, score: str) -> str:
    ones = f"(select count(*) from {table} where label = 1)"
    zeros = f"(select count(*) from {table} where label = 0)"
    return f"({_AUC.format(t=table, s=score)} - {ones} * ({ones} + 1) / 2.0::double) / ({ones} * {zeros}::double)"


@query("roc_auc", _RATED + f"select round({_auc('rated', 'score')}, 6) roc_auc")
def _(src):
    return rounded(metrics.roc_auc(rated(src)), "roc_auc")


@query("run_log_recorded", _RATED + f"""select 'recorded_score' run_name, '50' threshold,
    round({_auc('rated', 'score')}, 6) roc_auc""")
def _(src):
    """The recorded churn score logged as a run and read back."""
    path = scratch_path(src.spark, "runs")
    auc = metrics.roc_auc(rated(src)).first()["roc_auc"]
    models.log_run(src.spark, path, "recorded_score", {"threshold": 50}, auc)
    runs = models.read_runs(src.spark, path)
    return rounded(runs.select("run_name", F.col("params")["threshold"].alias("threshold"), "roc_auc"), "roc_auc")


@query("roc_curve", _RATED + """select cast('infinity' as double) threshold, 0.0::double fpr, 0.0::double tpr union all
    select distinct score, round(sum(1 - label) over w / (select sum(1 - label) from rated), 6),
        round(sum(label) over w / (select sum(label) from rated), 6)
    from rated window w as (order by score desc range between unbounded preceding and current row)""")
def _(src):
    return rounded(metrics.roc_curve(rated(src)), "fpr", "tpr")


@query("confusion_matrix", _RATED + """select cast(l as int) as label, cast(p as int) prediction,
    (select count(*) from rated where label = l and prediction = p) as rows from range(2) a(l), range(2) b(p)""")
def _(src):
    return metrics.confusion_matrix(rated(src))


@query("classification_report", _RATED + """, parts as (select c, name,
        (select count(*) from rated where label = c and prediction = c) hit,
        (select count(*) from rated where prediction = c) said, (select count(*) from rated where label = c) support
        from (values (0, 'Retained'), (1, 'Churned')) v(c, name)),
    figures as (select name, coalesce(hit / nullif(said, 0), 0) p, coalesce(hit / nullif(support, 0), 0) r,
        coalesce(2 * hit / nullif(said + support, 0), 0) f, support from parts),
    accuracy as (select avg(case when label = prediction then 1.0::double else 0 end) a, count(*) n from rated)
    select name row_name, round(p, 6) as precision, round(r, 6) recall, round(f, 6) f1, support from figures union all
    select 'accuracy', round(a, 6), round(a, 6), round(a, 6), n from accuracy union all
    select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(support) as bigint) from figures union all
    select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
        round(sum(f * support) / sum(support), 6), cast(sum(support) as bigint) from figures""")
def _(src):
    return rounded(metrics.classification_report(rated(src)), "precision", "recall", "f1")


@query("model_compare", f""", churn_score as (select churn_value as label, churn_score score from billing),
    charges as (select churn_value as label, monthly_charges score from billing),
    runs as (select 'churn_score' run_name, {_auc('churn_score', 'score')} auc union all
        select 'monthly_charges', {_auc('charges', 'score')})
    select run_name, round(auc, 6) roc_auc, auc = max(auc) over () best from runs""")
def _(src):
    """Two rankings of the customers, logged as runs and compared."""
    path = scratch_path(src.spark, "runs")
    labelled = src.billing.select(F.col("churn_value").alias("label"), "churn_score", "monthly_charges")
    for score in ("churn_score", "monthly_charges"):
        auc = metrics.roc_auc(labelled, "label", score).first()[0]
        models.log_run(src.spark, path, score, {"score": score}, auc)
    return rounded(metrics.model_compare(models.read_runs(src.spark, path), "monthly_charges"), "roc_auc")


# --- explanation -------------------------------------------------------------------------------------------------

_BETA = {"tenure": -0.5, "monthly_charges": 0.25, "churn_score": 1.5, "cltv": -0.125}


_PHI = ", phis as (" + " union all ".join(
    f"""select customer_id, '{c}' feature, {b}::double * (cast({c} as double) -
    (select avg(cast({c} as double)) from split_rows where split = 'train')) phi from split_rows where split = 'test'"""
    for c, b in _BETA.items()) + ") "


def fixed_attributions(src) -> DataFrame:
    """Attributions of fixed coefficients over raw inputs, so that the result has a closed form."""
    names = list(_BETA)
    split = trained(src).split.select(
        "customer_id", "split", F.array(*[F.col(c).cast("double") for c in names]).alias("features")
    )
    train = split.filter(F.col("split") == "train")
    means = list(train.agg(*[F.avg(F.get("features", F.lit(i))) for i in range(len(names))]).first())
    test = split.filter(F.col("split") == "test")
    return explain.linear_attribution(test, list(_BETA.values()), means, names, vector=False)


@query("linear_attribution", _PHI + "select customer_id, feature, round(phi, 6) phi from phis")
def _(src):
    return rounded(fixed_attributions(src), "phi")


@query("linear_attribution_fitted")
def _(src):
    t = trained(src)
    means = explain.feature_means(t.balanced, t.names)
    return explain.linear_attribution(t.test, list(t.logistic.coefficients), means, t.names)


@query("sampled_shapley")
def _(src):
    return trained(src).attributions


@query("attributions_write", _PHI + "select customer_id, feature, round(phi, 6) phi from phis")
def _(src):
    path = artifacts.attributions_write(fixed_attributions(src), scratch_path(src.spark, "attributions-out"))
    return rounded(src.spark.read.parquet(path), "phi")


@query("linear_importance", _PHI + """select feature, round(avg(abs(phi)), 6) importance from phis group by feature
    order by avg(abs(phi)) desc limit 3""")
def _(src):
    """The strongest features under the fixed coefficients."""
    return rounded(explain.top_features(fixed_attributions(src), 3), "importance")


@query("linear_explanation", _PHI + """, top as (select customer_id, churn_score / 100.0::double p from split_rows
        where split = 'test' order by churn_score desc, customer_id limit 1)
    select customer_id, feature, round(phi, 6) phi, p churn_probability, 0.5::double base_value
    from phis join top using (customer_id)""")
def _(src):
    """The riskiest test customer by recorded score, under the fixed coefficients."""
    scored = trained(src).test.join(
        src.billing.select("customer_id", (F.col("churn_score") / F.lit(100.0)).alias("churn_probability")), "customer_id"
    )
    return rounded(explain.explain_customer(fixed_attributions(src), rates.riskiest_customer(scored), 0.5), "phi")


@query("global_importance")
def _(src):
    return explain.global_importance(trained(src).attributions)


@query("top_features")
def _(src):
    return explain.top_features(trained(src).attributions)


@query("explain_customer")
def _(src):
    t = trained(src)
    riskiest = rates.riskiest_customer(models.score_customers(t.winner, t.test))
    return explain.explain_customer(t.attributions, riskiest, t.base_value)
