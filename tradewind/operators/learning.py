"""Classifiers and what surrounds them: encoding, sampling, scoring, evaluation."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..settings import CUSTOMER, PAIR, PRODUCT
from ..sources.stages import materialize
from .aggregates import category_codes
from .boosting import BoostedTrees, Boosting
from .folds import FoldBoosting, FoldLinear
from .forest import Forest, ForestModel
from .neighbours import nearest_rows

LABEL = "label"


def hashed(key: Column) -> Column:
    """First 32 bits of the key's md5 as a number: a random order that any engine can repeat."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


# encoding


@dataclass
class Encoder:
    """Fitted encoding: ordinal codes of categories and standardised numbers in ``features``.

    Columns with few values are indexed by the pipeline.  Ids with very many values (``wide``) have
    their codes in tables and are joined, so their values never pass through the driver.  A row with
    a category that was not fitted is left out, by either way."""

    pipeline: PipelineModel
    columns: list[str]
    codes: dict[str, DataFrame] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        for col, table in self.codes.items():
            df = df.join(table, col)
        return self.pipeline.transform(df)

    def places(self) -> dict[str, int]:
        """The place of each column in ``features``."""
        parts = [s.getInputCols() for s in self.pipeline.stages if isinstance(s, VectorAssembler)]
        numbers = parts[0] if len(parts) > 1 else []
        plain = [c.removesuffix("_code") if c.endswith("_code") else c.removesuffix("_num") for c in parts[-1] if c != "scaled"]
        return {c: i for i, c in enumerate([*plain, *numbers])}


def encode_features(df: DataFrame, label: str, wide: tuple[str, ...] = (CUSTOMER,), only: list[str] | None = None) -> Encoder:
    """Fit the encoding; columns are treated by type, every one but ``label`` (or just ``only``)."""
    fields = [f for f in df.schema.fields if f.name != label and (only is None or f.name in only)]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    other = [f.name for f in fields if not isinstance(f.dataType, T.NumericType)]
    narrow = [c for c in other if c not in wide]
    codes = {c: materialize(category_codes(df, c).withColumnRenamed("code", f"{c}_code")) for c in other if c in wide}
    plain = ", ".join([f"{c}_at + 0.0 AS {c}_code" for c in narrow] + [f"{c}_code + 0.0 AS {c}_num" for c in codes])
    stages = []
    if narrow:
        as_text = ", ".join(f"CAST({c} AS STRING) AS {c}_text" for c in narrow)
        stages.append(SQLTransformer(statement=f"SELECT *, {as_text} FROM __THIS__"))
        stages.append(
            StringIndexer(
                inputCols=[f"{c}_text" for c in narrow],
                outputCols=[f"{c}_at" for c in narrow],
                handleInvalid="skip",
                stringOrderType="alphabetAsc",
            )
        )
    if plain:
        # Adding 0.0 leaves plain numbers: trees then split on the order of the codes.
        stages.append(SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"))
    inputs = [f"{c}_code" for c in narrow] + [f"{c}_num" for c in codes]
    if numeric:
        stages.append(VectorAssembler(inputCols=numeric, outputCol="numbers", handleInvalid="skip"))
        stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True))
        inputs.append("scaled")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip"))
    # Nothing is fitted to the codes, and every value but null has one: rows are not joined with them to fit the rest.
    coded = df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in codes], F.lit(True)))
    coded = coded.withColumns({f"{c}_code": F.lit(0).cast("bigint") for c in codes})
    return Encoder(Pipeline(stages=stages).fit(coded), [f.name for f in fields], codes)


def ordinal_codes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Add ``<col>_code`` for each column: its value's place among the sorted distinct values."""
    for c in cols:
        df = df.join(category_codes(df, c).withColumnRenamed("code", f"{c}_code"), c)
    return df


# sampling


def train_test_split(df: DataFrame, key: Column, pct: int = 80) -> DataFrame:
    """Add ``split`` by a hash of the row's key: the same rows on every run and partitioning."""
    return df.withColumn("split", F.when(hashed(key) % 100 < pct, "train").otherwise("test"))


def pick_by_hash(df: DataFrame, label: str, key: Column, wanted: DataFrame | None = None) -> DataFrame:
    """Exactly ``wanted`` (``[label, n]``) rows of each class, those with the smallest key hash; by
    default as many of each as the smallest class has.

    Rows are counted in 65,536 hash buckets per class; whole buckets are taken up to the one where
    the quota ends, and a part of that one by rank."""
    rows = df.withColumn("hash", F.md5(key)).withColumn("bucket", F.substring("hash", 1, 4))
    counts = materialize(rows.groupBy(label, "bucket").agg(F.count(F.lit(1)).alias("size")))
    if wanted is None:
        sizes = counts.groupBy(label).agg(F.sum("size").alias("n"))
        wanted = sizes.select(label, sizes.agg(F.min("n").alias("n")).scalar().alias("n"))
    upto = Window.partitionBy(label).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = (
        counts.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .join(wanted, label)
        .withColumn("left", F.col("n") - F.col("before"))
        .where("left > 0")
        .select(label, "bucket", F.when(F.col("left") < F.col("size"), F.col("left")).alias("part"))
    )
    # Whole buckets pass; only the rows of the one bucket per class where the quota ends are ranked.
    taken = rows.join(quota, [label, "bucket"])
    order = Window.partitionBy(label).orderBy("hash")
    partial = taken.where("part IS NOT NULL").withColumn("rank", F.row_number().over(order)).where("rank <= part")
    return taken.where("part IS NULL").select(*df.columns).unionByName(partial.select(*df.columns))


def undersample(df: DataFrame, label: str, key: Column) -> DataFrame:
    """Every class reduced to the size of the smallest one."""
    return pick_by_hash(df, label, key)


def smote_upsample(
    df: DataFrame, label: str, cols: list[str], key: Column, k: int = 5, seed: int = 1, per_range: int = 5000
) -> DataFrame:
    """``[label, *cols]`` with the smaller of two classes raised to the size of the larger one.

    Each new row lies between a row of the smaller class and one of its k neighbours, at a share drawn from a hash.
    Neighbours are the k nearest of the whole class, sought in blocks of ``per_range`` rows.  Needs two rows of each
    class."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("size")).orderBy("size", label).collect()
    if len(sizes) != 2:
        raise ValueError("two classes are needed")
    (small, few), (_, many) = [(r[label], r["size"]) for r in sizes]
    rows = df.where(F.col(label) == small).withColumn("key", key)
    each, extra = divmod(many - few, few)
    one_more = pick_by_hash(rows.withColumn("one", F.lit(1)), "one", F.col("key"), df.sparkSession.createDataFrame([(1, extra)], "one int, n long"))
    numbers = F.sequence(F.lit(1), F.lit(each)) if each else F.array().cast("array<int>")
    copies = rows.join(one_more.select("key", "one"), "key", "left").select(
        "key", F.explode(F.when(F.col("one") == 1, F.array_append(numbers, F.lit(0))).otherwise(numbers)).alias("copy")
    )
    near = nearest_rows(rows, cols, k, per_range)
    tag = F.concat_ws("|", F.col("key"), F.col("copy").cast("string"), F.lit(str(seed)))
    width = len(cols)
    taken = (hashed(tag) % (F.size("others") / width).cast("bigint")).cast("int")
    made = copies.join(near, "key").select(
        "at",
        F.slice("others", taken * width + 1, F.lit(width)).alias("to"),
        (hashed(F.concat(tag, F.lit("|share"))) / float(2**32)).alias("share"),
    )
    cells = [
        (F.get("at", F.lit(i)) + F.col("share") * (F.get("to", F.lit(i)) - F.get("at", F.lit(i)))).alias(c)
        for i, c in enumerate(cols)
    ]
    new = made.select(F.lit(small).alias(label), *cells)
    return df.select(label, *[F.col(c).cast("double").alias(c) for c in cols]).unionByName(new)


# models


@dataclass
class Classifier:
    """A fitted encoder and a fitted model, of MLlib, ``BoostedTrees`` or ``ForestModel``."""

    encoder: Encoder
    model: object

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.encoder.transform(df))

    def save(self, path: str) -> None:
        """Write encoder, code tables and model under ``path``."""
        spark = SparkSession.active()
        self.encoder.pipeline.write().overwrite().save(f"{path}/encoder")
        kind = next((k for k, cls in OWN_MODELS.items() if isinstance(self.model, cls)), "mllib")
        if kind != "mllib":
            self.model.save(f"{path}/model")
        else:
            PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        for column, table in self.encoder.codes.items():
            table.write.mode("overwrite").parquet(f"{path}/codes/{column}")
        about = [(c, c in self.encoder.codes, kind) for c in self.encoder.columns]
        spark.createDataFrame(about, "name string, coded boolean, kind string").coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Classifier:
        """What ``save`` wrote."""
        about = spark.read.parquet(f"{path}/columns").collect()
        codes = {r.name: spark.read.parquet(f"{path}/codes/{r.name}") for r in about if r.coded}
        encoder = Encoder(PipelineModel.load(f"{path}/encoder"), [r.name for r in about], codes)
        own = OWN_MODELS.get(about[0].kind)
        return cls(encoder, own.load(spark, f"{path}/model") if own else PipelineModel.load(f"{path}/model").stages[0])


OWN_MODELS = {"boosted": BoostedTrees, "forest": ForestModel}


#: Text columns with few values, which the encoder may keep as labels; all others are coded by tables.
FEW_VALUES = ("srp_1_desc", "dtl_line_type", "dtl_value_package", "county", "customer_price_group", "family", "state", "kind")


def sampled(data: DataFrame, sampling: str, key: Column) -> DataFrame:
    """Training rows as they are (``default``), with the larger class reduced (``downsample``), or with whole rows of
    the smaller class repeated until both are of one size (``upsample``)."""
    if sampling == "default":
        return data
    if sampling == "downsample":
        return undersample(data, LABEL, key)
    if sampling != "upsample":
        raise ValueError(f"unknown sampling {sampling}")
    sizes = sorted((r["size"], r[LABEL]) for r in data.groupBy(LABEL).agg(F.count(F.lit(1)).alias("size")).collect())
    (few, small), (many, _) = sizes
    each, extra = divmod(many, few)
    minor = data.where(F.col(LABEL) == small)
    more = pick_by_hash(minor, LABEL, key, data.sparkSession.createDataFrame([(small, extra)], "label double, n long"))
    copies = minor.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(each)))).drop("_copy")
    return data.where(F.col(LABEL) != small).unionByName(copies).unionByName(more)


def _fit(train: DataFrame, label: Column, only: list[str] | None, estimator, sampling: str) -> Classifier:
    data = train.withColumn(LABEL, label.cast("double"))
    wide = tuple(f.name for f in data.schema.fields if f.name not in FEW_VALUES and isinstance(f.dataType, T.StringType))
    encoder = encode_features(data, LABEL, wide=wide, only=only)
    key = F.to_json(F.struct(*[F.col(c) for c in train.columns]))
    fitted = encoder.transform(sampled(data, sampling, key)).select("features", LABEL)
    return Classifier(encoder, estimator.fit(fitted))


def win_model(train: DataFrame, features: list[str], iterations: int = 100, sampling: str = "default") -> Classifier:
    """Boosted trees for winning (``iswon``)."""
    return _fit(train, F.col("iswon") == "True", features, Boosting(iterations, depth=3, step=0.1), sampling)


def propensity_model(train: DataFrame, features: list[str], trees: int = 100, depth: int = 20, sampling: str = "default") -> Classifier:
    """Random forest for buying again soon (``outcome``)."""
    return _fit(train, F.col("outcome"), features, Forest(trees, depth), sampling)


def batch_predict(classifier: Classifier, df: DataFrame, probability: bool = False) -> DataFrame:
    """``df`` with ``predicted`` (0 or 1), or with ``win_prob``, the probability of class 1."""
    scored = classifier.transform(df)
    if probability:
        return scored.select(*df.columns, vector_to_array("probability")[1].alias("win_prob"), F.col("prediction").cast("bigint").alias("predicted"))
    return scored.select(*df.columns, F.col("prediction").cast("bigint").alias("predicted"))


# evaluation, from [label, predicted]


def accuracy(df: DataFrame) -> DataFrame:
    return df.agg(F.avg((F.col(LABEL) == F.col("predicted")).cast("int")).alias("accuracy"))


def confusion_matrix(df: DataFrame) -> DataFrame:
    """``[label, predicted, n]`` including the empty cells; the rows are read once."""
    cells = materialize(df.groupBy(LABEL, "predicted").agg(F.count(F.lit(1)).alias("n")))
    classes = cells.agg(F.array_distinct(F.concat(F.collect_set(LABEL), F.collect_set("predicted"))).alias("classes"))
    grid = classes.select("classes", F.explode("classes").alias(LABEL)).select(LABEL, F.explode("classes").alias("predicted"))
    return grid.join(cells, [LABEL, "predicted"], "left").select(LABEL, "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def classification_report(df: DataFrame) -> DataFrame:
    """``[label, precision, recall, f1, support]`` per class, with accuracy and both averages."""
    cells = confusion_matrix(df)
    hit = F.when(F.col(LABEL) == F.col("predicted"), F.col("n")).otherwise(0)
    truth = cells.groupBy(LABEL).agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    called = cells.groupBy(F.col("predicted").alias(LABEL)).agg(F.sum("n").alias("called"))
    zero = F.lit(0.0)
    rates = truth.join(called, LABEL).select(
        F.col(LABEL).cast("string").alias(LABEL),
        F.coalesce(F.try_divide("hits", "called"), zero).alias("precision"),
        F.coalesce(F.try_divide("hits", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hits"), F.col("called") + F.col("support")), zero).alias("f1"),
        "support",
        "hits",
    )
    figures = ["precision", "recall", "f1"]
    total = F.sum("support").alias("support")
    weigh = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    macro = rates.agg(*[F.avg(c).alias(c) for c in figures], total).withColumn(LABEL, F.lit("macro avg"))
    weighted = rates.agg(*[weigh(c).alias(c) for c in figures], total).withColumn(LABEL, F.lit("weighted avg"))
    right = rates.agg(*[(F.sum("hits") / F.sum("support")).alias(c) for c in figures], total).withColumn(LABEL, F.lit("accuracy"))
    return rates.drop("hits").unionByName(macro).unionByName(weighted).unionByName(right)


# scoring any pair


def impute_predict(
    requests: DataFrame, scored: DataFrame, near_customers: DataFrame, near_products: DataFrame, values: tuple[str, ...] = ("predicted",)
) -> DataFrame:
    """``[customer, product, outcome, imputed]`` for any requested pair; with several ``values`` to impute, one outcome under each
    one's name, from the same joins.

    ``scored`` holds the training rows with their ``predicted`` value; ``near_*`` give the closest
    trained id (``[id, nearest]``) of ids that are not trained on.  A trained pair gets the most
    frequent value of its rows (imputed 0).  A new pair gets that of all rows of its customer or
    its product, each replaced by the nearest trained one if needed (imputed 1).  Ids unknown
    altogether give -1 (customer), -2 (product) or -3 (imputed -1).

    The rows are never listed per request.  They are counted by customer, product and pair; each customer and product
    is resolved once, with its counts per value attached, so the requests meet three tables: customers,
    products and known pairs.  The most frequent value of "customer or product" is one that the customer has, or the
    product's own most frequent one.  A row carries one count per distinct value, of which predictions have few."""
    counts = materialize(scored.groupBy(*PAIR, *values).agg(F.count(F.lit(1)).alias("n")))
    places = range(len(values))

    def held(by: list[str], name: str) -> DataFrame:
        """``[by, name]``: for each of ``values`` a map from it to its number of rows."""
        tables = []
        for i, v in enumerate(values):
            sums = counts.groupBy(*by, F.col(v).alias("v")).agg(F.sum("n").alias("n"))
            tables.append(sums.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("v", "n"))).alias(f"_{i}")))
        joined = reduce(lambda one, other: one.join(other, by), tables)
        return joined.select(*by, F.struct(*[f"_{i}" for i in places]).alias(name))

    def resolved(table: DataFrame, key: str, name: str, near: DataFrame) -> DataFrame:
        """``[key, id, name]`` of trained ids, and of those with a trained neighbour."""
        linked = near.select(F.col("id").alias("asked"), F.col("nearest").alias(key)).join(table.select(key), F.col("asked") == table[key], "left_anti").join(table, key)
        return table.select(F.col(key).alias("asked"), key, name).unionByName(linked.select("asked", key, name)).withColumnRenamed(key, f"{name}_id").withColumnRenamed("asked", key)

    by_c = resolved(held([CUSTOMER], "of_c"), CUSTOMER, "of_c", near_customers)
    by_p = resolved(held([PRODUCT], "of_p"), PRODUCT, "of_p", near_products)
    by_pair = held(PAIR, "of_pair").select(F.col(CUSTOMER).alias("of_c_id"), F.col(PRODUCT).alias("of_p_id"), "of_pair")
    asked = requests.select(*PAIR).join(by_c, CUSTOMER, "left").join(by_p, PRODUCT, "left").join(by_pair, ["of_c_id", "of_p_id"], "left")

    def most(entries: Column) -> Column:
        """The value with the greatest count, the smallest on ties."""
        return F.array_min(F.transform(entries, lambda e: F.struct((-e["value"]).alias("neg"), e["key"].alias("v"))))["v"]

    zero = F.lit(0).cast("bigint")
    known_c, known_p = F.col("of_c").isNotNull(), F.col("of_p").isNotNull()
    own = F.col("of_pair").isNotNull() & (F.col("of_c_id") == F.col(CUSTOMER)) & (F.col("of_p_id") == F.col(PRODUCT))
    unknown = F.when(known_c, 0).otherwise(-1) + F.when(known_p, 0).otherwise(-2)

    def outcome(i: int) -> Column:
        of_c, of_p, of_pair = (F.col(f"{name}._{i}") for name in ("of_c", "of_p", "of_pair"))
        count = lambda entries, v: F.coalesce(F.try_element_at(entries, v), zero)
        asked_for = F.array_union(F.map_keys(of_c), F.array(most(F.map_entries(of_p))))
        either = F.transform(asked_for, lambda v: F.struct(v.alias("key"), (count(of_c, v) + count(of_p, v) - count(of_pair, v)).alias("value")))
        return F.when(own, most(F.map_entries(of_pair))).when(known_c & known_p, most(either)).otherwise(unknown)

    names = values if len(values) > 1 else ("outcome",)
    return asked.select(
        *PAIR,
        *[outcome(i).alias(name) for i, name in enumerate(names)],
        F.when(own, 0).when(known_c & known_p, 1).otherwise(-1).alias("imputed"),
    )


def impute_accuracy(df: DataFrame) -> DataFrame:
    """Share of requested pairs whose ``outcome`` equals their ``truth``."""
    return df.agg(F.avg((F.col("outcome") == F.col("truth")).cast("int")).alias("accuracy"))


def permutation_importance(
    classifier: Classifier, df: DataFrame, label: Column, features: list[str], key: Column, n: int = 5, per_bucket: int = 5000
) -> DataFrame:
    """``[feature, score]``: mean loss of accuracy when a feature's values are shuffled.

    Rows are encoded once; those that cannot be are left out.  They fall into random buckets of about ``per_bucket`` rows, and
    each takes the feature of the next row of its bucket in a random order, so no single task orders all rows.  A row meets
    that neighbour once per repeat, with all its encoded features; every feature of every repeat is scored in one job.  For
    boosted trees rows travel as bins, a byte per feature, and are not repeated per feature."""
    model, places = classifier.model, classifier.encoder.places()
    boosted = isinstance(model, BoostedTrees)
    encoded = classifier.encoder.transform(df.withColumn(LABEL, label.cast("double")).withColumn("key", key))
    rows = materialize(encoded.select("key", LABEL, (model.bins("features") if boosted else vector_to_array("features")).alias("x")))
    buckets = max(1, -(-rows.count() // per_bucket))
    reps = rows.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(n))))
    draw = F.md5(F.concat_ws("|", F.col("key"), F.col("rep").cast("string")))
    reps = reps.select(LABEL, "x", "rep", draw.alias("draw")).withColumn("bucket", hashed(F.concat(F.col("draw"), F.lit("b"))) % buckets)
    reps = reps.withColumn("draw", F.unhex("draw"))
    order = Window.partitionBy("rep", "bucket").orderBy("draw")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The last row of a bucket takes the first row's values.
    other = F.when(F.row_number().over(order) == F.count(F.lit(1)).over(whole), F.first("x").over(whole)).otherwise(F.lead("x").over(order))
    met = reps.select(LABEL, "x", other.alias("other"))
    if boosted:
        *shares, base = model.swapped(met.where(F.col(LABEL).isNotNull()), [places[c] for c in features])
        return df.sparkSession.createDataFrame([(c, base - share) for c, share in zip(features, shares)], "feature string, score double")
    predicted = lambda frame: model.transform(frame.withColumn("features", array_to_vector("x"))).withColumn("predicted", F.col("prediction"))
    base = accuracy(predicted(rows)).first().accuracy
    asked = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(places[c]).alias("at")) for c in features]))
    # In one select Spark would repeat the rows before it looks for their neighbours.
    met = met.select(LABEL, "other", "x", asked.alias("asked")).select(LABEL, "other", "x", "asked.feature", "asked.at")
    shuffled = F.transform("x", lambda v, i: F.when(i == F.col("at"), F.get("other", i)).otherwise(v))
    hits = predicted(met.select("feature", LABEL, shuffled.alias("x"))).groupBy("feature")
    return hits.agg((F.lit(float(base)) - F.avg((F.col(LABEL) == F.col("predicted")).cast("int"))).alias("score"))


def default_models() -> dict:
    """Estimators of MLlib, and models that are fitted on all folds at once."""
    shared = {"featuresCol": "features", "labelCol": LABEL}
    return {
        "LR": FoldLinear("logistic"),
        "NB": NaiveBayes(**shared, modelType="gaussian"),
        "RF": RandomForestClassifier(**shared, numTrees=100, seed=0),
        "SVC": FoldLinear("hinge"),
        "DT": DecisionTreeClassifier(**shared, seed=0),
        "GBT": FoldBoosting(),
    }


def model_comparison(df: DataFrame, label: Column, features: list[str], key: Column, models: dict | None = None, k: int = 5) -> DataFrame:
    """``[model, fold, accuracy]`` over k folds taken by a hash of the row's key."""
    data = df.withColumn(LABEL, label.cast("double")).withColumn("fold", hashed(key) % k)
    encoded = materialize(encode_features(data, LABEL, only=features).transform(data).select("features", LABEL, "fold"))
    results = []
    for name, estimator in (models or default_models()).items():
        if isinstance(estimator, FoldLinear | FoldBoosting):
            results += [(name, fold + 1, right) for fold, right in enumerate(estimator.accuracies(encoded, k))]
            continue
        for fold in range(k):
            fitted = estimator.fit(encoded.where(F.col("fold") != fold))
            tested = fitted.transform(encoded.where(F.col("fold") == fold)).select(LABEL, F.col("prediction").alias("predicted"))
            results.append((name, fold + 1, accuracy(tested).first().accuracy))
    return df.sparkSession.createDataFrame(results, "model string, fold int, accuracy double")
