"""Joint training of a linear projection and a classifier on top of it, over stored embeddings.

The loss of a mini-batch is a weighted sum of masked cross-entropy and supervised contrastive loss. A step averages the
gradients of many mini-batches, which tasks work out side by side: every epoch deals the rows to mini-batches by a seeded
hash of their key and writes each mini-batch as one row, so a step reads just its own folder and a mini-batch never spans
two tasks. Tasks add up their gradients before anything is sent, sums meet in a tree, and the driver gets at most
``FAN`` of them, each the size of the parameters. It keeps the parameters and moments of AdamW and no data.

A step waits for the one before. Where steps are so small (``STEP_BYTES``) that starting a job takes longer than the step,
a task takes a run of them (``RUN_BYTES`` of vectors at most) one after the other and gives the state on to the next run.

The key must be unique. Rows whose vector is missing, of another width or not finite are left out, and so are rows that
neither mask selects. A mini-batch without a masked row has no loss. An interrupted training goes on from the last
finished epoch and gives the same parameters up to rounding.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.checks import require_choice, require_columns, require_in_range, require_non_negative, require_positive
from tagloom.functions.vectors import argmax, is_valid_vector
from tagloom.operators.neighbors import vector_width
from tagloom.operators.ranking import best_so_far
from tagloom.operators.sizing import staged, staging_path
from tagloom.plans.evaluate import evaluate_batches, evaluate_embeddings
from tagloom.sources import paths

FAN = 64
#: Steps over fewer bytes of vectors are taken in runs, by one task each; a run has at most ``RUN_BYTES``.
STEP_BYTES = 2**20
RUN_BYTES = 32 * 2**20
SCHEDULES = ["constant", "linear", "cosine"]
#: Scores the best epoch may be chosen by, and whether the lower one is better.
SAVE_BEST_BY = {"loss": True, "accuracy": False, "f1": False, "knn_macro_f1": False, "recall_at_1": False}
#: Added to both sums of the contrastive loss, as its evaluation does.
FLOOR = 1e-12
NORM_FLOOR = 1e-12
MASKS = ("classification_mask", "metric_mask")


@dataclass(frozen=True)
class Settings:
    width: int | None = None
    epochs: int = 3
    batch_rows: int = 64
    batches_per_step: int = 16
    learning_rate: float = 1e-3
    weight_decay: float = 0.01
    clip: float | None = 1.0
    classification_weight: float = 1.0
    metric_weight: float = 1.0
    temperature: float = 0.1
    smoothing: float = 0.0
    schedule: str = "linear"
    warmup_steps: int = 0
    cycles: float = 0.5
    save_best_by: str = "f1"
    recall_at: tuple[int, ...] = (1, 10)
    knn_k: int = 10
    distance: str = "cos"
    keep_batches: int | None = None
    seed: int = 42

    def __post_init__(self):
        require_positive(width=self.width, epochs=self.epochs, batch_rows=self.batch_rows, batches_per_step=self.batches_per_step)
        require_choice(self.schedule, SCHEDULES, "schedule")
        require_choice(self.save_best_by, SAVE_BEST_BY, "save_best_by")
        require_non_negative(weight_decay=self.weight_decay, warmup_steps=self.warmup_steps, smoothing=self.smoothing)
        if self.save_best_by == "recall_at_1" and 1 not in self.recall_at:
            raise ValueError("recall_at_1 is not among the recalls to measure")


@dataclass(frozen=True)
class JointModel:
    """``vector @ projection + offset`` is the embedding; its product with ``head`` plus ``bias`` are the class scores."""

    projection: np.ndarray
    offset: np.ndarray
    head: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(dim: int, width: int, classes: int, seed: int) -> JointModel:
        """The identity where the width allows it, else a random orthonormal projection; a small random head."""
        rng = np.random.default_rng(seed)
        turned = np.eye(dim, width) if width >= dim else np.linalg.qr(rng.normal(size=(dim, width)))[0]
        return JointModel(turned, np.zeros(width), rng.normal(scale=1 / math.sqrt(width), size=(width, classes)), np.zeros(classes))

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (self.projection, self.offset, self.head, self.bias)])

    def like(self, flat: np.ndarray) -> JointModel:
        """The parameters of ``flat`` in the shape of this model."""
        shapes = [a.shape for a in (self.projection, self.offset, self.head, self.bias)]
        ends = np.cumsum([math.prod(s) for s in shapes])
        return JointModel(*(part.reshape(s) for part, s in zip(np.split(flat, ends[:-1]), shapes, strict=True)))


def cross_entropy_gradient(scores: np.ndarray, labels: np.ndarray, mask: np.ndarray, smoothing: float) -> tuple[float, np.ndarray]:
    """Mask-weighted mean cross-entropy of a mini-batch and its gradient by the class scores."""
    gradient = np.zeros_like(scores)
    if not (mask > 0).any():
        return 0.0, gradient
    shifted = scores - scores.max(axis=1, keepdims=True)
    log_probs = shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))
    wanted = np.full_like(scores, smoothing / scores.shape[1])
    wanted[np.arange(len(labels)), labels] += 1 - smoothing
    weight = mask / mask.sum()
    gradient = weight[:, None] * (np.exp(log_probs) - wanted)
    return float(-(weight * (wanted * log_probs).sum(axis=1)).sum()), gradient


def contrastive_gradient(unit: np.ndarray, labels: np.ndarray, mask: np.ndarray, temperature: float) -> tuple[float, np.ndarray]:
    """Supervised contrastive loss of the masked rows of a mini-batch and its gradient by the unit vectors."""
    gradient = np.zeros_like(unit)
    chosen = np.flatnonzero(mask > 0)
    if len(chosen) < 2:
        return 0.0, gradient
    tau = max(temperature, 1e-8)
    u, own = unit[chosen], labels[chosen]
    weight = np.exp(u @ u.T / tau)
    np.fill_diagonal(weight, 0.0)
    same = own[:, None] == own[None, :]
    np.fill_diagonal(same, False)
    pairs = same.sum(axis=1)
    if not pairs.any():
        return 0.0, gradient
    near, whole = (weight * same).sum(axis=1), weight.sum(axis=1)
    has = pairs > 0
    loss = -np.log((near[has] + FLOOR) / (whole[has] + FLOOR)).sum() / pairs.sum()
    by_score = weight / (whole + FLOOR)[:, None] - weight * same / (near + FLOOR)[:, None]
    by_score *= has[:, None] / pairs.sum()
    gradient[chosen] = (by_score + by_score.T) @ u / tau
    return float(loss), gradient


def batch_gradient(model: JointModel, vectors: np.ndarray, labels: np.ndarray, masks: np.ndarray, settings: Settings):
    """Both losses of a mini-batch and the gradient of their weighted sum by all parameters, flat."""
    embedded = vectors @ model.projection + model.offset
    norms = np.maximum(np.linalg.norm(embedded, axis=1, keepdims=True), NORM_FLOOR)
    unit = embedded / norms
    classified, by_score = cross_entropy_gradient(embedded @ model.head + model.bias, labels, masks[:, 0], settings.smoothing)
    contrast, by_unit = contrastive_gradient(unit, labels, masks[:, 1], settings.temperature)
    by_score *= settings.classification_weight
    by_unit *= settings.metric_weight
    by_embedded = by_score @ model.head.T + (by_unit - unit * (unit * by_unit).sum(axis=1, keepdims=True)) / norms
    gradient = JointModel(vectors.T @ by_embedded, by_embedded.sum(axis=0), embedded.T @ by_score, by_score.sum(axis=0))
    return classified, contrast, gradient.flat()


def usable_rows(rows: DataFrame, key: str, vector: str, label: str, dim: int, masks: tuple[str, str]) -> DataFrame:
    """Rows that training can learn from, under the names it uses."""
    kept = rows.filter(is_valid_vector(F.col(vector), dim)).select(
        F.col(key).alias("key"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.col(label).cast("int").alias("label"),
        *[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(n) for m, n in zip(masks, MASKS, strict=True)],
    )
    return kept.filter((F.col(MASKS[0]) > 0) | (F.col(MASKS[1]) > 0))


def deal(rows: DataFrame, batches: int, batches_per_step: int, seed: int) -> DataFrame:
    """One row per mini-batch, with its ``step``; a seeded hash of the key says which mini-batch a row goes to."""
    batch = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(batches))
    members = F.sort_array(F.collect_list(F.struct("key", "vector", "label", *MASKS)))
    packed = rows.groupBy(batch.alias("batch")).agg(members.alias("members"))
    return packed.withColumn("step", F.floor(F.col("batch") / F.lit(batches_per_step)).cast("int"))


SUMS = "slot int, batches bigint, classification double, contrast double, gradient binary"


def _add(parts: pa.Table) -> pa.Table:
    """Sums of one group of a tree, in the order of their slots."""
    parts = parts.sort_by("slot")
    total = sum(np.frombuffer(g, np.float64) for g in parts["gradient"].to_pylist())
    row = [parts["slot"][0].as_py() // FAN]
    row += [sum(parts[c].to_pylist()) for c in ("batches", "classification", "contrast")]
    return pa.table([pa.array([v], t) for v, t in zip([*row, total.tobytes()], _SUM_TYPES, strict=True)], names=_SUM_NAMES)


_SUM_NAMES = [f.split()[0] for f in SUMS.split(", ")]
_SUM_TYPES = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]


def _members(members: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, labels and masks of a mini-batch."""
    rows = members.values
    vectors = rows.field("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
    masks = np.stack([rows.field(m).to_numpy(zero_copy_only=False) for m in MASKS], axis=1)
    return vectors, rows.field("label").to_numpy(zero_copy_only=False), masks


def step_gradient(batches: DataFrame, model: JointModel, settings: Settings) -> tuple[float, float, np.ndarray, int]:
    """Mean losses and gradient over mini-batches (``members``), and how many there were."""
    spark = batches.sparkSession
    shared = spark.sparkContext.broadcast((model, settings))

    def run(packs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, settings = shared.value
        count, classified, contrast, total = 0, 0.0, 0.0, np.zeros(len(model.flat()))
        for pack in packs:
            for members in pack.column(0):
                a, b, gradient = batch_gradient(model, *_members(members), settings)
                count, classified, contrast = count + 1, classified + a, contrast + b
                total += gradient
        if count:
            row = (TaskContext.get().partitionId(), count, classified, contrast, total.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _SUM_TYPES, strict=True)], names=_SUM_NAMES)

    source = batches.select("members")
    parts, slots = source.mapInArrow(run, SUMS), source.rdd.getNumPartitions()
    while slots > FAN:
        parts = parts.groupBy(F.floor(F.col("slot") / F.lit(FAN))).applyInArrow(_add, SUMS)
        slots = -(-slots // FAN)
    try:
        rows = sorted(parts.collect(), key=lambda r: r["slot"])  # at most FAN rows
    finally:
        shared.destroy()
    count = sum(r["batches"] for r in rows)
    if count == 0:
        return 0.0, 0.0, np.zeros(len(model.flat())), 0
    gradient = sum(np.frombuffer(bytes(r["gradient"]), np.float64) for r in rows) / count
    return sum(r["classification"] for r in rows) / count, sum(r["contrast"] for r in rows) / count, gradient, count


def learning_rate(settings: Settings, step: int, steps: int) -> float:
    """Rate of a step counted from 0: linear warm-up, then constant, linear decay or cosine."""
    if step < settings.warmup_steps and settings.schedule != "constant":
        return settings.learning_rate * step / max(1, settings.warmup_steps)
    done = (step - settings.warmup_steps) / max(1, steps - settings.warmup_steps)
    factor = {
        "constant": 1.0,
        "linear": max(0.0, 1 - done),
        "cosine": max(0.0, 0.5 * (1 + math.cos(2 * math.pi * settings.cycles * done))),
    }[settings.schedule]
    return settings.learning_rate * factor


@dataclass
class State:
    """All a training needs to go on: parameters, moments, counters, and the best parameters so far."""

    flat: np.ndarray
    first: np.ndarray
    second: np.ndarray
    epoch: int = 0
    step: int = 0
    best: np.ndarray | None = None
    best_epoch: int | None = None
    log: list[dict] = field(default_factory=list)

    def update(self, gradient: np.ndarray, rate: float, settings: Settings) -> None:
        """One step of AdamW on a gradient whose norm is cut at ``clip``."""
        size = np.linalg.norm(gradient)
        if settings.clip is not None and size > settings.clip:
            gradient = gradient * (settings.clip / size)
        self.step += 1
        self.flat = self.flat * (1 - rate * settings.weight_decay)
        self.first = 0.9 * self.first + 0.1 * gradient
        self.second = 0.999 * self.second + 0.001 * gradient**2
        mean, spread = self.first / (1 - 0.9**self.step), self.second / (1 - 0.999**self.step)
        self.flat = self.flat - rate * mean / (np.sqrt(spread) + 1e-8)


def steps_per_run(settings: Settings, dim: int) -> int:
    """How many steps a task takes in a row; 1 where a step is worth many tasks."""
    size = 8 * dim * settings.batch_rows * settings.batches_per_step
    return max(1, RUN_BYTES // size) if size < STEP_BYTES else 1


RUN = "step int, flat binary, first binary, second binary, losses array<struct<classification: double, contrast: double, batches: bigint>>"


def run_of_steps(batches: DataFrame, state: State, shape: JointModel, settings: Settings, steps: int) -> list[tuple[float, float, int]]:
    """Take the steps of a run of mini-batches (``step``, ``batch``, ``members``) in order; mean losses of each step.

    ``state`` is brought up to date; ``steps`` counts those of an epoch.
    """
    spark = batches.sparkSession
    shared = spark.sparkContext.broadcast((State(state.flat, state.first, state.second, step=state.step), shape, settings))

    def run(packs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, shape, settings = shared.value
        state = replace(given)
        losses, current, count, classified, contrast, total = [], None, 0, 0.0, 0.0, np.zeros(len(state.flat))

        def finish():
            losses.append({"classification": classified / count, "contrast": contrast / count, "batches": count})
            state.update(total / count, learning_rate(settings, state.step, steps * settings.epochs), settings)

        for pack in packs:
            for step, members in zip(pack.column(0).to_pylist(), pack.column(1), strict=True):
                if step != current:
                    if count:
                        finish()
                    current, count, classified, contrast, total = step, 0, 0.0, 0.0, np.zeros(len(state.flat))
                a, b, gradient = batch_gradient(shape.like(state.flat), *_members(members), settings)
                count, classified, contrast, total = count + 1, classified + a, contrast + b, total + gradient
        if count:
            finish()
            arrays = [a.tobytes() for a in (state.flat, state.first, state.second)]
            row = dict(zip(("step", "flat", "first", "second", "losses"), (state.step, *arrays, losses), strict=True))
            yield pa.RecordBatch.from_pylist([row], schema=names)

    names = pa.schema(
        [("step", pa.int32()), *[(n, pa.binary()) for n in ("flat", "first", "second")]]
        + [("losses", pa.list_(pa.struct([("classification", pa.float64()), ("contrast", pa.float64()), ("batches", pa.int64())])))]
    )
    ordered = batches.coalesce(1).sortWithinPartitions("step", "batch").select("step", "members")  # a run, never an epoch
    try:
        done = ordered.mapInArrow(run, RUN).collect()  # one row or none
    finally:
        shared.destroy()
    for row in done:
        state.step = row["step"]
        state.flat, state.first, state.second = (np.frombuffer(bytes(row[n]), np.float64) for n in ("flat", "first", "second"))
    return [tuple(loss) for row in done for loss in row["losses"]]


STATE = "epoch int, step int, flat binary, first binary, second binary, best binary, best_epoch int, log string, settings string"


def save_state(spark: SparkSession, state: State, settings: Settings, path: str) -> None:
    """One small table per finished epoch; Spark's committer makes it whole or absent."""
    arrays = [a if a is None else a.tobytes() for a in (state.flat, state.first, state.second, state.best)]
    row = (state.epoch, state.step, *arrays, state.best_epoch, json.dumps(state.log), json.dumps(asdict(settings), sort_keys=True))
    spark.createDataFrame([row], STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch-{state.epoch:05d}")


def load_state(spark: SparkSession, path: str, settings: Settings) -> State | None:
    """The last finished epoch's state; None where there is none. Other settings than those it was trained with are an error."""
    epoch = settings.epochs
    while epoch > 0 and not paths.exists(spark, f"{path}/epoch-{epoch:05d}/_SUCCESS"):
        epoch -= 1
    if epoch == 0:
        return None
    row = spark.read.schema(STATE).parquet(f"{path}/epoch-{epoch:05d}").first()
    if row["settings"] != json.dumps(asdict(settings), sort_keys=True):
        raise ValueError(f"{path} holds a training with other settings: {row['settings']}")
    arrays = [None if row[n] is None else np.frombuffer(bytes(row[n]), np.float64) for n in ("flat", "first", "second", "best")]
    return State(*arrays[:3], row["epoch"], row["step"], arrays[3], row["best_epoch"], json.loads(row["log"]))


def project(rows: DataFrame, model: JointModel, vector: str = "embedding", out: str = "embedding", probs: str = "probs") -> DataFrame:
    """``rows`` with the unit embedding ``out`` and the class probabilities ``probs``; null for an invalid vector."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    dim = model.projection.shape[0]

    def lists(values: np.ndarray, present: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(present * values.shape[1])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()), mask=pa.array(~present))

    @F.arrow_udf("struct<embedding: array<double>, probs: array<double>>")
    def embed(vectors: pa.Array) -> pa.Array:
        model = shared.value
        present = vectors.is_valid().to_numpy(zero_copy_only=False)
        points = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
        embedded = points @ model.projection + model.offset
        scores = embedded @ model.head + model.bias
        raised = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
        unit = embedded / np.maximum(np.linalg.norm(embedded, axis=1, keepdims=True), NORM_FLOOR)
        chances = raised / raised.sum(axis=1, keepdims=True) if len(scores) else scores
        return pa.StructArray.from_arrays([lists(unit, present), lists(chances, present)], names=["embedding", "probs"])

    valid = F.when(is_valid_vector(F.col(vector), dim), F.col(vector).cast("array<double>"))
    done = rows.withColumn("_embedded", embed(valid))
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in (out, probs)]
    return done.select(*kept, F.col("_embedded.embedding").alias(out), F.col("_embedded.probs").alias(probs))


def validate(train: DataFrame, validation: DataFrame, model: JointModel, settings: Settings) -> dict[str, float]:
    """Mean losses over mini-batches, scores of the classifier, recalls and k-NN score of the embeddings.

    Validation rows are judged against the training rows with a metric mask, of the last ``keep_batches`` mini-batches
    where that is set, as an embedding bank.
    """
    judged = project(validation, model, "vector").withColumnRenamed("key", "val_id")
    judged = staged(judged.drop("vector").withColumn("pred", argmax(F.col("probs"))), "judged")
    losses = evaluate_batches(
        judged,
        key="val_id",
        temperature=settings.temperature,
        smoothing=settings.smoothing,
        classification_weight=settings.classification_weight,
        metric_weight=settings.metric_weight,
    )
    bank = project(train, model, "vector").select(F.col("key").alias("vec_id"), "batch_id", "label", "embedding", "metric_mask")
    near = evaluate_embeddings(
        judged,
        staged(bank, "bank"),
        ks=list(settings.recall_at),
        knn_k=settings.knn_k,
        keep_batches=settings.keep_batches,
        distance=settings.distance,
    )
    scores = {r["name"]: r["value"] for r in losses.unionByName(near).collect()}  # a dozen rows
    return {"loss" if n == "classification_loss" else n: v for n, v in scores.items()}


@dataclass(frozen=True)
class Trained:
    """The best model, the last one, and a log row per epoch: mean training losses and validation scores."""

    model: JointModel
    last: JointModel
    best_epoch: int
    log: list[dict]

    def log_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([{"run": 0, **row} for row in self.log])


def _best_epoch(spark: SparkSession, log: list[dict], by: str) -> int:
    """The last epoch that was strictly better than all before it."""
    rows = spark.createDataFrame([(0, r["epoch"], float(r[by])) for r in log], "run int, epoch int, score double")
    marked = best_so_far(rows, ["run"], "epoch", "score", "best", minimize=SAVE_BEST_BY[by])
    return marked.filter("best").agg(F.max("epoch")).first()[0]


def train_joint(
    train: DataFrame,
    validation: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    masks: tuple[str, str] = MASKS,
    classes: int | None = None,
    dim: int | None = None,
    settings: Settings = Settings(),
    checkpoint_path: str | None = None,
    stop_after: int | None = None,
) -> Trained:
    """Train for ``settings.epochs`` and keep the epoch that validates best.

    Tables carry a unique ``key``, a vector, a dense ``label`` and two masks. With ``checkpoint_path`` every finished epoch
    is saved there, and a training that finds saved epochs goes on after the last; ``stop_after`` ends one early.
    """
    spark = train.sparkSession
    for name, table in {"training rows": train, "validation rows": validation}.items():
        require_columns(table, [key, vector, label, *masks], name)
    dim = dim or vector_width(train, vector)
    if dim == 0:
        raise ValueError("training needs at least one usable vector")
    rows = staged(usable_rows(train, key, vector, label, dim, masks), "training_rows")
    judged = usable_rows(validation, key, vector, label, dim, masks)
    total = rows.count()
    if total == 0:
        raise ValueError("neither mask selects a training row with a usable vector")
    if classes is None:
        classes = 1 + max(t.agg(F.max("label")).first()[0] or 0 for t in (rows, judged))
    for table in (rows, judged):
        require_in_range(table, ["label"], classes)
    batches = max(1, -(-total // settings.batch_rows))
    steps = -(-batches // settings.batches_per_step)
    in_run = steps_per_run(settings, dim)
    parts = max(1, -(-judged.count() // settings.batch_rows))
    judged = judged.withColumn("batch_id", F.pmod(F.xxhash64(F.lit(settings.seed), "key"), F.lit(parts)))
    judged = staged(judged, "validation_rows")

    shape = JointModel.start(dim, settings.width or dim, classes, settings.seed)
    start = shape.flat()
    state = (load_state(spark, checkpoint_path, settings) if checkpoint_path else None) or State(start, 0 * start, 0 * start)
    while state.epoch < settings.epochs and state.epoch != stop_after:
        seed = settings.seed * 1_000_003 + state.epoch
        folder = staging_path(spark, "mini_batches")
        dealt = deal(rows, batches, settings.batches_per_step, seed).withColumn("run", F.floor(F.col("step") / F.lit(in_run)).cast("int"))
        dealt.write.partitionBy("run").parquet(folder)
        schema = dealt.drop("run").schema
        # a run without rows has no folder; listing one folder a run, not all of them, keeps the work of a step the same
        filled = set(paths.names(spark, folder))
        losses = []
        for number in range(-(-steps // in_run)):
            if f"run={number}" not in filled:
                continue
            run = spark.read.schema(schema).parquet(f"{folder}/run={number}")
            if in_run > 1:
                losses += run_of_steps(run, state, shape, settings, steps)
                continue
            rate = learning_rate(settings, state.step, steps * settings.epochs)
            classified, contrast, gradient, count = step_gradient(run, shape.like(state.flat), settings)
            if count:
                losses.append((classified, contrast, count))
                state.update(gradient, rate, settings)
        paths.remove(spark, folder)
        batch = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(batches)).alias("batch_id")
        scores = validate(rows.select("*", batch), judged, shape.like(state.flat), settings)
        dealt_batches = sum(n for *_, n in losses)
        means = [sum(row[i] * row[2] for row in losses) / dealt_batches for i in (0, 1)]
        state.epoch += 1
        state.log.append({"epoch": state.epoch, "train_classification_loss": means[0], "train_metric_loss": means[1], **scores})
        if _best_epoch(spark, state.log, settings.save_best_by) == state.epoch:
            state.best, state.best_epoch = state.flat, state.epoch
        if checkpoint_path:
            save_state(spark, state, settings, checkpoint_path)
    best = state.flat if state.best is None else state.best
    return Trained(shape.like(best), shape.like(state.flat), state.best_epoch or 0, list(state.log))
