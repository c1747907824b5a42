"""Image preprocessing as one Arrow stage over an image table.

Spark partitions the images; inside a task the steps run on stacks of
equally-sized images, so numpy works on ``(n, height, width, 3)`` arrays.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from terrasift.functions.numeric import quoted

# Constants of the preprocessing steps.
CHANNEL_MEANS_RGB = (123.68, 116.78, 103.94)
SHORT_EDGE = (256, 480)
JITTER_SIGMA = 0.01
BLUR_WEIGHTS = (1, 4, 6, 4, 1)
OPENING_SIZE = 5
LUMA_RGB = (299, 587, 114)  # in thousandths
FEATURE_MEAN, FEATURE_STD = 0.5, 0.5
FEATURE_SIZE = 64
# End of fixed values.

STEPS = ("resize", "mean", "jitter", "equalize", "blur", "open", "wavelet")
BATCH_ROWS = 32


@dataclass(frozen=True)
class ImageOptions:
    """Which steps run. ``rgb_constants_on_bgr`` keeps the published pipeline's
    habit of using RGB-ordered constants on BGR data; ``wavelet`` is ``edges``
    (approximation removed) or ``smooth`` (details removed). ``feature_size``
    adds a ``features`` column."""

    steps: tuple = STEPS
    seed: int = 0
    short_edge: tuple = SHORT_EDGE
    rgb_constants_on_bgr: bool = False
    wavelet: str = "edges"
    feature_size: int | None = None
    keep_pixels: bool = True
    carry: tuple = field(default_factory=tuple)


def decode(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Stored bytes to (h, w, 3): grey is repeated, alpha dropped."""
    image = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(image, 3, axis=2) if channels == 1 else image[:, :, :3]


def to_bytes(images: np.ndarray) -> np.ndarray:
    return np.clip(images, 0, 255).astype(np.uint8)


def rounded(values: np.ndarray) -> np.ndarray:
    return to_bytes(np.floor(values + 0.5))


def bilinear_taps(size_in: int, size_out: int):
    """Two source positions per target and the share of the second; half-pixel
    centres, edges clamped."""
    centres = (np.arange(size_out) + 0.5) * (size_in / size_out) - 0.5
    low = np.floor(centres).astype(int)
    return np.clip(low, 0, size_in - 1), np.clip(low + 1, 0, size_in - 1), (centres - low).astype(np.float32)


def triangle_weights(size_in: int, size_out: int) -> np.ndarray:
    """Antialiasing weights (out × in): a triangle as wide as the shrinking factor."""
    scale = size_in / size_out
    centres = (np.arange(size_out) + 0.5) * scale - 0.5
    distance = np.abs(np.arange(size_in)[None, :] - centres[:, None])
    weights = np.maximum(0.0, 1.0 - distance / max(scale, 1.0))
    return (weights / weights.sum(axis=1, keepdims=True)).astype(np.float32)


def _stretch(images, axis, size, antialias):
    size_in = images.shape[axis]
    if size_in == size:
        return images
    if antialias and size < size_in:
        return np.moveaxis(np.moveaxis(images, axis, -1) @ triangle_weights(size_in, size).T, -1, axis)
    low, high, share = bilinear_taps(size_in, size)
    share = share.reshape([-1 if i == axis % images.ndim else 1 for i in range(images.ndim)])
    first = np.take(images, low, axis=axis)
    return first + (np.take(images, high, axis=axis) - first) * share


def resize(images: np.ndarray, height: int, width: int, antialias=False) -> np.ndarray:
    if images.shape[-3:-1] == (height, width):
        return images
    return rounded(_stretch(_stretch(images.astype(np.float32), -3, height, antialias), -2, width, antialias))


def subtract_means(images: np.ndarray, bgr_means) -> np.ndarray:
    return images - np.asarray(bgr_means)


def jitter(image: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Shift one image along its colours' principal axes."""
    flat = image.reshape(-1, 3).astype(np.float32)
    axes, strengths, _ = np.linalg.svd(np.cov(flat.T))
    return to_bytes(flat + axes @ (alpha * strengths)).reshape(image.shape)


def equalize_luma(images: np.ndarray, weights_bgr) -> np.ndarray:
    """Spread the luma histogram of each image over 0..255, colour differences kept."""
    stack = images.astype(np.int32)
    luma = (sum(w * stack[..., c] for c, w in enumerate(weights_bgr)) + 500) // 1000
    flat = luma.reshape(len(stack), -1)
    counts = np.stack([np.bincount(row, minlength=256) for row in flat])
    first = (counts > 0).argmax(axis=1)
    lowest = counts[np.arange(len(stack)), first]
    remaining = flat.shape[1] - lowest
    table = np.floor((counts.cumsum(axis=1) - lowest[:, None]) * 255.0 / np.maximum(remaining, 1)[:, None] + 0.5)
    table = np.where(remaining[:, None] > 0, np.clip(table, 0, 255), np.arange(256)[None, :]).astype(np.int32)
    spread = np.take_along_axis(table, flat, axis=1).reshape(luma.shape)
    return to_bytes(stack + (spread - luma)[..., None])


def _shifted(images, axis, **padding):
    """The image moved by -2..2 along one axis."""
    reach = OPENING_SIZE // 2
    pad = [(0, 0)] * images.ndim
    pad[axis] = (reach, reach)
    size = images.shape[axis]
    if padding.get("mode") == "reflect" and size <= reach:
        padding = {"mode": "symmetric"}
    wide = np.pad(images, pad, **padding)
    before = (slice(None),) * (axis % images.ndim)
    return [wide[(*before, slice(k, k + size))] for k in range(2 * reach + 1)]


def blur(images: np.ndarray) -> np.ndarray:
    """5×5 Gaussian, borders mirrored without repeating the edge pixel.

    The weights add up to 16 per axis, so 16-bit integers hold every sum.
    """
    out = images.astype(np.uint16)
    for axis in (-3, -2):
        out = reduce(np.add, [part * np.uint16(w) for part, w in zip(_shifted(out, axis, mode="reflect"), BLUR_WEIGHTS)])
    return ((out + 128) >> 8).astype(np.uint8)


def opening(images: np.ndarray) -> np.ndarray:
    """Erosion then dilation with a square; pixels outside the image never win."""
    out = images
    for fill, pick in ((255, np.minimum), (0, np.maximum)):
        for axis in (-3, -2):
            out = reduce(pick, _shifted(out, axis, mode="constant", constant_values=fill))
    return out


def haar(images: np.ndarray, mode="edges") -> np.ndarray:
    """One Haar level per channel. Its approximation band is the mean of each
    2×2 block, so removing it leaves the pixel minus the block mean, and
    removing the details leaves the block mean."""
    height, width = images.shape[-3:-1]
    pad = [(0, 0)] * (images.ndim - 3) + [(0, height % 2), (0, width % 2), (0, 0)]
    full = np.pad(images.astype(np.int16), pad, mode="edge")
    corners = [(slice(i, None, 2), slice(j, None, 2), slice(None)) for i in (0, 1) for j in (0, 1)]
    total = sum(full[(..., *corner)] for corner in corners)
    for corner in corners:
        view = full[(..., *corner)]
        full[(..., *corner)] = total >> 2 if mode == "smooth" else np.maximum(4 * view - total, 0) >> 2
    return full[..., :height, :width, :].astype(np.uint8)


def feature_values(images: np.ndarray, size: int) -> np.ndarray:
    """RGB planes at ``size``², scaled to [-1, 1]: (n, 3·size·size)."""
    small = resize(images, size, size, antialias=True)[..., ::-1]
    scaled = ((small / 255.0 - FEATURE_MEAN) / FEATURE_STD).astype(np.float32)
    return np.moveaxis(scaled, -1, -3).reshape(*images.shape[:-3], -1)


def generator(path: str, seed: int) -> np.random.Generator:
    """Random numbers that depend on the image alone, so a retry repeats them."""
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(f"{seed}|{path}".encode(), digest_size=8).digest()))


def _run_steps(stack, paths, options):
    means = CHANNEL_MEANS_RGB if options.rgb_constants_on_bgr else CHANNEL_MEANS_RGB[::-1]
    luma = LUMA_RGB if options.rgb_constants_on_bgr else LUMA_RGB[::-1]
    for step in options.steps:
        if step == "mean":
            stack = subtract_means(stack, means)
            if "jitter" not in options.steps:
                stack = to_bytes(stack)
        elif step == "jitter":
            draws = [generator(p, options.seed + 1).normal(0, JITTER_SIGMA, 3) for p in paths]
            stack = np.stack([jitter(image, a) for image, a in zip(stack, draws)])
        elif step == "equalize":
            stack = equalize_luma(stack, luma)
        elif step == "blur":
            stack = blur(stack)
        elif step == "open":
            stack = opening(stack)
        elif step == "wavelet":
            stack = haar(stack, options.wavelet)
        elif step != "resize":
            raise ValueError(f"unknown step {step!r}")
    return stack


def _prepare(row, options):
    image = decode(row.data, row.height, row.width, row.channels)
    if "resize" not in options.steps:
        return image
    factor = generator(row.path, options.seed).uniform(*options.short_edge) / min(image.shape[:2])
    return resize(image, int(image.shape[0] * factor), int(image.shape[1] * factor))


def _process(rows, options):
    """Rows of one batch -> {row position: (pixels, features) or exception}."""
    images, results = {}, {}
    for i, row in enumerate(rows):
        try:
            images[i] = _prepare(row, options)
        except Exception as err:
            results[i] = err
    shapes = {}
    for i, image in images.items():
        shapes.setdefault(image.shape, []).append(i)
    for members in shapes.values():
        try:
            done = _finish(np.stack([images[i] for i in members]), [rows[i].path for i in members], options)
            results.update(zip(members, done))
        except Exception:
            for i in members:
                try:
                    results[i] = _finish(images[i][None], [rows[i].path], options)[0]
                except Exception as err:
                    results[i] = err
    return results


def _finish(stack, paths, options):
    pixels = _run_steps(stack, paths, options)
    features = feature_values(pixels, options.feature_size) if options.feature_size else [None] * len(pixels)
    return list(zip(pixels, features))


def output_schema(df: DataFrame, options: ImageOptions) -> T.StructType:
    fields = [df.schema["path"], *[df.schema[c] for c in options.carry],
              T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()),
              T.StructField("channels", T.IntegerType())]
    if options.keep_pixels:
        fields.append(T.StructField("data", T.BinaryType()))
    if options.feature_size:
        fields.append(T.StructField("features", T.ArrayType(T.FloatType())))
    return T.StructType([*fields, T.StructField("status", T.StringType()), T.StructField("error", T.StringType())])


def preprocess(df: DataFrame, options: ImageOptions = ImageOptions()) -> DataFrame:
    """Run the chosen steps on ``path, height, width, channels, data`` rows.

    An image that fails becomes a row with ``status`` "error"; the rest of the
    batch goes on. Pixels are BGR bytes as in Spark's image source.
    """
    schema = output_schema(df, options)
    names = schema.fieldNames()

    def work(batches):
        for batch in batches:
            # Small slices keep the working set at a few images, whatever the Arrow batch holds.
            for start in range(0, len(batch), BATCH_ROWS):
                rows = list(batch.iloc[start:start + BATCH_ROWS].itertuples(index=False))
                results = _process(rows, options)
                yield pd.DataFrame([_as_row(row, results[i], options) for i, row in enumerate(rows)], columns=names)

    wanted = ["path", *options.carry, "height", "width", "channels", "data"]
    return df.select(*[quoted(c) for c in wanted]).mapInPandas(work, schema)


def _as_row(row, result, options):
    base = [row.path, *[getattr(row, c) for c in options.carry]]
    failed = isinstance(result, Exception)
    pixels, features = (None, None) if failed else result
    base += [None, None, None] if failed else list(pixels.shape)
    if options.keep_pixels:
        base.append(None if failed else pixels.astype(np.uint8).tobytes())
    if options.feature_size:
        base.append(None if failed else features)
    return [*base, "error" if failed else "ok", f"{type(result).__name__}: {result}" if failed else None]


def pixel_table(df: DataFrame, keep=()) -> DataFrame:
    """One row per pixel and channel ``(path, y, x, c, value)``, for checks and reports."""
    digits = F.hex("data")
    count = (F.octet_length("data") - 1).cast("int")
    exploded = df.filter(F.octet_length("data") > 0).select(
        "path", *keep, "width", "channels", digits.alias("digits"), F.explode(F.sequence(F.lit(0), count)).alias("i"))
    value = F.conv(F.substring(F.col("digits"), F.col("i") * 2 + 1, F.lit(2)), 16, 10).cast("int")
    cell = F.col("i").cast("double") / F.col("channels")
    pixel = F.floor(cell).cast("int")
    return exploded.select("path", *keep, F.floor(pixel / F.col("width")).cast("int").alias("y"),
                           (pixel % F.col("width")).alias("x"), (F.col("i") % F.col("channels")).alias("c"),
                           value.alias("value"))
