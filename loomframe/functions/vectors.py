"""Vector columns: slicing, scaling, assembling, limits, feature maps, normalisation. All JVM-side array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(v: Column | str) -> Column:
    return F.col(v) if isinstance(v, str) else v


def slice_vec(v, spans: list[tuple[int, int]]) -> Column:
    """Concatenation of half-open spans."""
    return F.concat(*[F.slice(col(v), a + 1, b - a) for a, b in spans])


def to_rad(v) -> Column:
    return F.transform(col(v), F.radians)


#: Divisors and thresholds of hand devices, for states and commands.
SCALES = {"claw": 100.0, "dexhand": 100.0, "gripper_state": 0.8, "gripper_command": 255.0}
THRESHOLDS = {"claw": 50.0, "dexhand": 50.0, "gripper_state": 0.4, "gripper_command": 70.0}


def scale_hand(v, device: str) -> Column:
    return F.transform(col(v), lambda x: x / SCALES[device])


def binarize_hand(v, device: str) -> Column:
    return F.transform(col(v), lambda x: F.when(x > THRESHOLDS[device], 1.0).otherwise(0.0))


def coalesce_hand(*devices) -> Column:
    """The first of several devices' vectors that isn't empty."""
    return F.coalesce(*[F.when(F.size(col(d)) > 0, col(d)) for d in devices])


def assemble(arms, hands, side: str = "both") -> Column:
    """16-D (left arm, left hand, right arm, right hand) or 8-D of one side from 14 joints and 2 hands."""
    arms, hands = col(arms), col(hands)
    left = F.concat(F.slice(arms, 1, 7), F.slice(hands, 1, 1))
    right = F.concat(F.slice(arms, 8, 7), F.slice(hands, 2, 1))
    return {"left": left, "right": right, "both": F.concat(left, right)}[side].cast("array<float>")


def overlay(action, traj, alternative) -> Column:
    """Command vector with dimensions 12 to 26 from the alternative, else from the trajectory."""
    action = col(action)
    return F.concat(F.slice(action, 1, 12), F.coalesce(col(alternative), col(traj)), F.slice(action, 27, F.greatest(F.size(action) - 26, F.lit(0))))


def append_base(action, pose, flag) -> Column:
    return F.concat(col(action), col(pose), F.array(col(flag).cast("double")))


def minus(a, b) -> Column:
    return F.zip_with(col(a), col(b), lambda x, y: x - y)


def is_valid(v, n: int) -> Column:
    """At least n finite components."""
    return F.coalesce((F.size(col(v)) >= n) & F.forall(col(v), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def violations(v, width: int) -> Column:
    """Reasons why a vector isn't an action of this width."""
    v = col(v)
    return F.array_compact(F.array(F.when(v.isNull() | (F.size(v) == 0), "empty"), F.when(F.size(v) != width, "width"), F.when(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), "non_finite")))


def clip(v, low: list[float], high: list[float]) -> Column:
    lo, hi = (F.array(*map(F.lit, x)) for x in (low, high))
    return F.zip_with(F.zip_with(col(v), lo, lambda x, y: F.greatest(x, y)), hi, lambda x, y: F.least(x, y))


def out_of_range(v, low: list[float], high: list[float]) -> Column:
    return F.exists(F.zip_with(col(v), clip(v, low, high), lambda a, b: a != b), lambda x: x)


def coerce_action(v, hands) -> Column:
    """A 14-D action becomes 16-D with the current hands; 16-D stays."""
    return F.when(F.size(col(v)) == 14, assemble(v, hands).cast("array<double>")).otherwise(col(v))


#: Normalised hand command to device range.
RANGES = {"claw": 80.0, "gripper": 255.0}


def eef_command(left, right, device: str = "claw") -> Column:
    """Both hands' commands in the device's range; null if one lies outside 0 to 1. A dexterous hand has six joints, the thumb's second fixed at 100."""
    left, right = col(left), col(right)
    ok = left.between(0, 1) & right.between(0, 1)
    if device == "dexhand":
        hand = lambda x: F.array(x * 100.0, F.lit(100.0), *[x * 100.0] * 4)
        return F.when(ok, F.concat(hand(left), hand(right)))
    return F.when(ok, F.array(left * RANGES[device], right * RANGES[device]))


def normalize_depth(v, low: float, high: float) -> Column:
    """Clip, then scale the frame's own range to 0..255; zeros if it has none."""
    c = F.transform(col(v), lambda x: F.greatest(F.least(x, F.lit(high)), F.lit(low)))
    lo, hi = F.array_min(c), F.array_max(c)
    return F.transform(c, lambda x: F.when(hi > lo, (x - lo) / (hi - lo) * 255.0).otherwise(0.0))


def feature_map(df: DataFrame, targets: dict[str, dict]) -> DataFrame:
    """Adds target columns: {"origins": [(column, start, end), ...], "subtract": column or None}."""
    out = {}
    for name, t in targets.items():
        v = F.concat(*[F.slice(F.col(c), a + 1, b - a) for c, a, b in t["origins"]])
        out[name] = minus(v, F.slice(F.col(t["subtract"]), t["origins"][0][1] + 1, t["origins"][0][2] - t["origins"][0][1])) if t.get("subtract") else v
    return df.withColumns(out)


def split_stats(df: DataFrame, stats: list[str], spans: dict[str, tuple[int, int]]) -> DataFrame:
    """Statistics vectors split by the same spans: rows (feature, stat columns). One origin for each target."""
    rows = [F.struct(F.lit(name).alias("feature"), *[F.slice(s, a + 1, b - a).alias(s) for s in stats]) for name, (a, b) in spans.items()]
    return df.select(F.inline(F.array(*rows)))


def normalize(v, stats: dict[str, Column | str], mode: str) -> Column:
    """mean_std: (x - mean) / std; min_max and quantiles: to [-1, 1]. No spread: 0."""
    a, b = {"mean_std": ("mean", "std"), "min_max": ("min", "max"), "quantiles": ("q01", "q99")}[mode]
    pair = F.arrays_zip(col(v).alias("x"), col(stats[a]).alias("a"), col(stats[b]).alias("b"))
    if mode == "mean_std":
        return F.transform(pair, lambda p: F.when(p["b"] > 0, (p["x"] - p["a"]) / p["b"]).otherwise(0.0))
    return F.transform(pair, lambda p: F.when(p["b"] > p["a"], (p["x"] - p["a"]) / (p["b"] - p["a"]) * 2 - 1).otherwise(0.0))


def unnormalize(v, stats: dict[str, Column | str], mode: str) -> Column:
    a, b = {"mean_std": ("mean", "std"), "min_max": ("min", "max"), "quantiles": ("q01", "q99")}[mode]
    pair = F.arrays_zip(col(v).alias("x"), col(stats[a]).alias("a"), col(stats[b]).alias("b"))
    if mode == "mean_std":
        return F.transform(pair, lambda p: p["x"] * p["b"] + p["a"])
    return F.transform(pair, lambda p: (p["x"] + 1) / 2 * (p["b"] - p["a"]) + p["a"])


def add_noise(v, scale: float, seed: int, skip: float = 0.2) -> Column:
    """Gaussian noise on each component; a row is left alone with chance `skip`. One draw a row and component, by seed."""
    x = col(v)
    noisy = F.transform(x, lambda e, i: e + scale * F.sqrt(-2 * F.log(_unit(x, i, seed))) * F.cos(2 * 3.141592653589793 * _unit(x, i, seed + 1)))
    return F.when(_unit(x, F.lit(-1), seed + 2) < skip, x).otherwise(noisy)


def _unit(x: Column, i: Column, seed: int) -> Column:
    """A number in (0, 1) from a row's vector, a place and a seed: the same however the table is dealt."""
    return (F.pmod(F.xxhash64(x, i, F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def l2(v) -> Column:
    return F.sqrt(F.aggregate(col(v), F.lit(0.0), lambda s, x: s + x * x))


def mean_abs(v) -> Column:
    return F.aggregate(col(v), F.lit(0.0), lambda s, x: s + F.abs(x)) / F.size(col(v))


def imu_vector(s: str) -> Column:
    """13 numbers from a struct of gyro, acc, free_acc (x, y, z) and quat (x, y, z, w)."""
    return F.array(*[F.col(f"{s}.{p}.{a}") for p in ("gyro", "acc", "free_acc") for a in "xyz"], *[F.col(f"{s}.quat.{a}") for a in "xyzw"])


def pose_vector(s: str) -> Column:
    return F.array(*[F.col(f"{s}.{a}") for a in ("x", "y", "yaw")])


def assemble_state(parts: list[str], side: str = "both") -> Column:
    """Halves of keyed parts, left halves first, or one side's."""
    half = lambda p, right: F.slice(p, F.lit(1) + right * (F.size(p) / 2).cast("int"), (F.size(p) / 2).cast("int"))
    sides = {"left": [0], "right": [1], "both": [0, 1]}[side]
    return F.concat(*[half(F.col(p), s) for s in sides for p in parts])


def redact(m) -> Column:
    """Map values whose key names a secret are replaced."""
    return F.transform_values(col(m), lambda k, v: F.when(F.upper(k).rlike("SECRET|TOKEN|KEY|URL"), F.lit("<set>")).otherwise(v))


def as_singleton(v) -> Column:
    return F.array(col(v))
