"""Cost allocation, erasure, text blobs, daily anomalies and classifier scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import running_total
from millrace.operators.relational import interval_join, ratio_to_report


# ---- cost allocation ---------------------------------------------------------

def allocate(df: DataFrame, keys, weight: str, amount: str, name: str = "allocated") -> DataFrame:
    """Split ``amount`` over the rows of a group in proportion to ``weight``."""
    shared = ratio_to_report(df, weight, keys, "__share")
    return shared.withColumn(name, F.col("__share") * F.col(amount)).drop("__share")


def allocate_credits(metering: DataFrame, queries: DataFrame, as_of: str, months: int = 6, closed: bool = True) -> DataFrame:
    """Credits per warehouse and user for each of the previous months, and query counts.

    A query joins every metering row whose period contains its start; with
    ``closed`` a start exactly on the boundary belongs to both periods, as in the
    published statement.  Counts count joined rows.
    """
    m = metering.where(F.col("start_time") > F.date_trunc("month", F.add_months(F.lit(as_of).cast("date"), -months)))
    q = queries.where("warehouse_size is not null").select("query_id", "user_name", "warehouse_id", "execution_time", F.col("start_time").alias("query_start"))
    joined = interval_join(q, m, ("warehouse_id", "entity_id"), "query_start", "start_time", "end_time", closed=closed)
    # the interval join is the dearest step: its sums per period and user are what both sides of the shares read
    used = joined.groupBy("name", "start_time", "end_time", "credits_used", "user_name").agg(F.sum("execution_time").alias("execution_time"), F.count(F.lit(1)).alias("n_queries"))
    costed = allocate(used, ["name", "start_time", "end_time"], "execution_time", "credits_used", "credit")
    month = F.months_between(F.trunc(F.lit(as_of).cast("date"), "month"), F.trunc("start_time", "month")).cast("int")
    aggs = []
    for kind, value in (("credits_in_prev_month", F.col("credit")), ("query_count_in_prev_month", F.col("n_queries"))):
        for i in range(1, months + 1):
            name = kind + (str(i) if i > 1 else "")
            total = F.sum(F.when(F.col("__m") == i, value).otherwise(0))
            aggs.append((F.round(total, 2) if kind.startswith("credits") else total).alias(name))
    return costed.withColumn("__m", month).groupBy(F.col("name").alias("warehouse_name"), "user_name").agg(*aggs)


# ---- privacy erasure ----------------------------------------------------------

def erase_customers(ids: DataFrame, reviews: DataFrame, purchases: DataFrame, as_of: str):
    """(reviews, purchases) that remain after erasing a set of customers.

    Reviews always go.  Purchases go only when nothing is owed either way and no
    purchase lies within a year of ``as_of``.
    """
    wanted = ids.select(F.col(ids.columns[0]).alias("__id")).distinct()
    limit = F.add_months(F.lit(as_of).cast("date"), -12)
    money = lambda c: F.sum(F.col(c).cast("decimal(18,2)"))
    settled = purchases.groupBy(F.col("customer_id").alias("__c")).agg((money("price") - money("paid")).alias("owed"), F.count_if(F.col("purchase_date") > limit).alias("recent")) \
        .where("owed = 0 and recent = 0").join(wanted, F.col("__c") == F.col("__id"), "left_semi").select("__c")
    return (reviews.join(wanted, F.col("customer_id") == F.col("__id"), "left_anti"),
            purchases.join(settled, F.col("customer_id") == F.col("__c"), "left_anti"))


# ---- text blobs -----------------------------------------------------------------

def explode_lines(df: DataFrame, column: str, separator: str, names, line_break: str = "\n") -> DataFrame:
    """Lines of a text blob as rows, tokens of a line as named columns; blank lines are dropped."""
    from millrace.functions.semantics import strtok
    from millrace.operators.semistructured import split_to_rows
    lines = split_to_rows(df, column, line_break, "__line", "line_no")
    out = lines.select(*[c for c in df.columns if c != column], "line_no", *[strtok("__line", separator, i).alias(n) for i, n in enumerate(names, 1)])
    return out.dropna(how="all", subset=list(names))


# ---- daily anomalies ---------------------------------------------------------------

def daily_totals(df: DataFrame, ts: str, value: str, series: str | None = None) -> DataFrame:
    keys = ([F.col(series).alias("series")] if series else [F.lit("all").alias("series")]) + [F.to_date(ts).alias("day")]
    return df.groupBy(*keys).agg(F.sum(F.col(value).cast("decimal(18,4)")).cast("double").alias("y"))


def _weekdays(daily: DataFrame, y, *more) -> DataFrame:
    """Moments of the series' days by weekday, from one aggregate that combines before it moves."""
    x = F.datediff("day", F.lit("1970-01-01")).cast("double")
    moments = {"n": F.regr_count(y, x), "mean_x": F.regr_avgx(y, x), "mean_y": F.regr_avgy(y, x), "sxx": F.regr_sxx(y, x), "sxy": F.regr_sxy(y, x), "syy": F.regr_syy(y, x)}
    return daily.groupBy("series", F.dayofweek("day").alias("dow")).agg(*[m.alias(n) for n, m in moments.items()], *more)


def _solved(weekdays: DataFrame, *kept) -> DataFrame:
    """The normal equations of a trend and an offset per weekday: their solution needs only the moments within the weekdays.

    Seven rows of a series give one: the common slope, the spread of the residuals and the means of each weekday.
    """
    weekday = F.when(F.col("n") > 0, F.struct("dow", "n", "mean_x", "mean_y"))
    sums = weekdays.groupBy(F.col("series").alias("model_series")).agg(
        F.sum("n").alias("days"), F.count_if(F.col("n") > 0).alias("k"), F.sum("sxx").alias("sxx"), F.sum("sxy").alias("sxy"), F.sum("syy").alias("syy"),
        F.sum(F.col("n") * F.col("mean_x")).alias("sum_x"), F.sum(F.col("n") * F.col("mean_y")).alias("sum_y"), F.collect_list(weekday).alias("weekdays"), *kept)
    slope = F.coalesce(F.try_divide(F.col("sxy"), F.col("sxx")), F.lit(0.0))
    free = F.col("days") - F.col("k") - 1
    rest = F.greatest(F.col("syy") - slope * F.col("sxy"), F.lit(0.0))
    return sums.where("days > 0").select("model_series", "days", "sxx", slope.alias("slope"), F.sqrt(F.when(free > 0, rest / free)).alias("sigma"), (F.col("sum_x") / F.col("days")).alias("mean_x"),
                                         (F.col("sum_y") / F.col("days")).alias("mean_y"), "weekdays", *[F.col(c) for c in sums.columns[8:] if c != "weekdays"])


def fit_daily(daily: DataFrame) -> DataFrame:
    """One model row per series: the least-squares fit of a trend and an offset for each weekday, in one pass over the days."""
    return _solved(_weekdays(daily, F.col("y")))


def _judged(days: DataFrame, z: float) -> DataFrame:
    """Forecast, bounds and flag of days that stand beside their model."""
    x = F.datediff("day", F.lit("1970-01-01")).cast("double")
    seen = F.get(F.filter("weekdays", lambda w: w["dow"] == F.dayofweek("day")), F.lit(0))
    days = days.withColumns({"__w": seen, "__x": x})
    away = F.col("__x") - F.coalesce("__w.mean_x", "mean_x")
    forecast = F.coalesce("__w.mean_y", "mean_y") + F.col("slope") * away
    wide = F.lit(z) * F.col("sigma") * F.sqrt(1 + 1 / F.coalesce("__w.n", "days") + F.coalesce(F.try_divide(away * away, F.col("sxx")), F.lit(0.0)))
    days = days.select("series", F.col("day").alias("ts"), "y", forecast.alias("forecast"), (forecast - wide).alias("lower_bound"), (forecast + wide).alias("upper_bound"))
    return days.withColumn("is_anomaly", (F.col("y") < F.col("lower_bound")) | (F.col("y") > F.col("upper_bound")))


def detect(model: DataFrame, daily: DataFrame, z: float = 2.5758) -> DataFrame:
    """Forecast, bounds and flag for new days.

    Bounds are those of a prediction: they widen with the distance from the days
    the model knows.  A weekday it has not seen takes the means of all days.
    """
    return _judged(daily.join(model, F.col("series") == F.col("model_series")), z)


def anomalies(daily: DataFrame, until: str, z: float = 2.5758) -> DataFrame:
    """Fit on the days up to ``until`` and judge those after it, from one pass over the days.

    The days to judge travel along with the moments of their weekday, so the input
    is neither read nor aggregated twice; a series has as many as the calendar.
    """
    known = F.col("day") <= F.lit(until).cast("date")
    later = F.collect_list(F.when(~known, F.struct("day", "y"))).alias("later")
    model = _solved(_weekdays(daily, F.when(known, F.col("y")), later), F.flatten(F.collect_list("later")).alias("later"))
    return _judged(model.withColumnRenamed("model_series", "series").select("*", F.inline("later")), z)


def alert(anomalies: DataFrame, since: str) -> DataFrame:
    """One row: is there an anomaly after ``since``."""
    return alerts(anomalies, [since]).select("fire")


def alerts(anomalies: DataFrame, since) -> DataFrame:
    """A row for each date of ``since``: is there an anomaly after it.  The anomalies are gone through once."""
    last = anomalies.agg(F.max(F.when(F.col("is_anomaly"), F.col("ts"))).alias("__last"))
    dates = F.explode(F.array(*[F.lit(d).cast("date") for d in since]))
    return last.select("__last", dates.alias("since")).select("since", F.coalesce(F.col("__last") > F.col("since"), F.lit(False)).alias("fire"))


# ---- classification -------------------------------------------------------------------

def hash_split(df: DataFrame, keys, training_pct: int = 95, name: str = "split_group") -> DataFrame:
    """Assign each row to training or inference by a hash of its key: stable in every read."""
    return df.withColumn(name, F.when(F.pmod(F.xxhash64(*keys), F.lit(100)) < training_pct, "training").otherwise("inference"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))
    return ratio_to_report(counts, "cnt", name="percent", scale=100.0)


def train_classifier(df: DataFrame, target: str, categorical=(), numeric=(), trees: bool = False, hashed: int = 1 << 12):
    """A fitted pipeline; rows with a missing number or target are skipped.

    Each categorical column is hashed into ``hashed`` inputs of its own, so a column
    of any number of values needs no list of them, and a value first met when predicting is no
    error.  Values that meet in an input share its weight.  Only the classes of the target are listed.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import FeatureHasher, StringIndexer, VectorAssembler
    stages = [StringIndexer(inputCol=target, outputCol="__label", handleInvalid="skip", stringOrderType="alphabetAsc")]
    stages += [FeatureHasher(inputCols=[c], outputCol=f"__{c}_v", categoricalCols=[c], numFeatures=hashed) for c in categorical]
    stages.append(VectorAssembler(inputCols=[*numeric, *[f"__{c}_v" for c in categorical]], outputCol="__features", handleInvalid="skip"))
    kind = GBTClassifier if trees else LogisticRegression
    stages.append(kind(featuresCol="__features", labelCol="__label"))
    return Pipeline(stages=stages).fit(df.where(F.col(target).isNotNull()))


def predict(model, df: DataFrame) -> DataFrame:
    """Predicted class, probability of each class; the target column is not needed."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    labels = model.stages[0].labels
    scored = PipelineModel(model.stages[1:]).transform(df)
    p = vector_to_array("probability")
    names = F.array(*[F.lit(x) for x in labels])
    return scored.select(*df.columns, F.element_at(names, (F.col("prediction") + 1).cast("int")).alias("predicted"),
                         *[p[i].alias(f"probability_{x}") for i, x in enumerate(labels)])


def importance(model, df: DataFrame) -> DataFrame:
    """Weight of each input, largest first; that of a hashed column is the sum of its hashed inputs.

    Trees bring their own importances; a linear model's coefficients are scaled by
    the spread of their inputs in ``df``, so that inputs of different units compare.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.stat import Summarizer
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        weights = last.featureImportances.toArray()
    else:
        inputs = PipelineModel(model.stages[1:-1]).transform(df)
        spread = inputs.agg(Summarizer.std(F.col("__features")).alias("s")).first()["s"].toArray()  # one number per input
        weights = abs(last.coefficients.toArray()) * spread
    names, at = [], 0
    for c in model.stages[-2].getInputCols():
        width = 1
        if c.endswith("_v"):
            width = next(s for s in model.stages if s.hasParam("numFeatures") and s.getOutputCol() == c).getNumFeatures()
        names.append((c.removeprefix("__").removesuffix("_v"), at, at + width))
        at += width
    rows = [(n, float(sum(weights[a:b]))) for n, a, b in names]
    return df.sparkSession.createDataFrame(rows, "feature string, score double").orderBy(F.desc("score"), "feature")


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n_rows"))


def metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, f1 and support per class, from the confusion counts."""
    cells = confusion(df, label, predicted)
    each = cells.select(F.explode(F.array(F.struct(F.col("actual").alias("class"), F.col("n_rows").alias("support"), F.lit(0).cast("bigint").alias("claimed"), F.when(F.col("actual") == F.col("predicted"), F.col("n_rows")).otherwise(0).alias("hit")),
                                         F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n_rows").alias("claimed"), F.lit(0).cast("bigint").alias("hit")))).alias("c")).select("c.*")
    sums = each.groupBy("class").agg(F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hit").alias("hit"))
    precision, recall = F.try_divide(F.col("hit"), F.col("claimed")), F.try_divide(F.col("hit"), F.col("support"))
    return sums.select("class", "support", precision.alias("precision"), recall.alias("recall"),
                       F.try_divide(F.lit(2) * F.col("hit"), F.col("claimed") + F.col("support")).alias("f1"))


def threshold_curve(df: DataFrame, label: str, score: str, decimals: int = 2) -> DataFrame:
    """Counts, precision and recall at every score threshold, scores rounded to ``decimals``.

    Rows are counted per rounded score before the running sums, so the ordered
    window holds at most ``10 ** decimals + 1`` rows for scores in [0, 1].
    """
    per = df.groupBy(F.round(F.col(score), decimals).alias("threshold")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    down = Window.orderBy(F.col("threshold").desc())
    whole = Window.partitionBy(F.lit(1))
    tp, fp = F.sum("p").over(down), F.sum("n").over(down)
    return per.select("threshold", tp.alias("tp"), fp.alias("fp"), (tp / (tp + fp)).alias("precision"), F.try_divide(tp, F.sum("p").over(whole)).alias("recall"),
                      F.try_divide(fp, F.sum("n").over(whole)).alias("false_positive_rate"))


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve by rank sums, ties counting half.

    Distinct scores are counted first; the negatives below each come from a running
    total over all scores, dealt by range, so scores of any distribution are spread evenly.
    """
    per = df.groupBy(F.col(score).cast("double").alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).where("p + n > 0")
    upto = running_total(per, "n", "s", name="upto")
    total = upto.agg(F.sum(F.col("p") * (F.col("upto") - F.col("n") / 2)).alias("w"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    return total.select(F.try_divide(F.col("w").cast("double"), (F.col("p") * F.col("n")).cast("double")).alias("auc"))
