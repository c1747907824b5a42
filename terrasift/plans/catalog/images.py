"""Image steps on 8×8 pictures that Spark derives from the embeddings.

Channel ``c`` of pixel ``i`` is the embedding value at ``(i + 21 c) mod 64``,
shifted by a half and scaled to 0..255.
"""

from pyspark.sql import functions as F

from terrasift.operators import pixels as ops
from terrasift.plans import imagery
from terrasift.plans.catalog import query, table
from terrasift.session import scratch_path
from terrasift.sources import images

SIDE = 8
FILES_PER_TASK = 1_000


def _level(x):
    return F.floor(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x.cast("double") + 0.5)) * 255)


def _bytes(rows):
    """Picture rows in the given order as hex of BGR bytes."""
    cells = F.sequence(F.lit(0), F.lit(SIDE * SIDE * 3 - 1))

    def cell(j):
        line, rest = F.floor(j / (SIDE * 3)), j % (SIDE * 3)
        i = rows(line) * SIDE + F.floor(rest / 3)
        place = (i + 21 * (rest % 3)) % (SIDE * SIDE)
        return F.lpad(F.hex(_level(F.get("embedding", place.cast("int")))), 2, "0")
    return F.array_join(F.transform(cells, cell), "")


def pictures(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("path"), "label", F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"),
        F.lit(3).alias("channels"), F.unhex(_bytes(lambda line: line)).alias("data"))


def _checksums(df):
    """Per picture and channel: sum of the values and of value × (position + 1)."""
    weight = F.col("y") * SIDE + F.col("x") + 1
    return (ops.pixel_table(df).groupBy(F.col("path").cast("bigint").alias("vec_id"), "c")
            .agg(F.sum("value").alias("total"), F.sum(F.col("value") * weight).alias("weighted")))


def _step(spark, folder, *steps, **options):
    return _checksums(ops.preprocess(pictures(spark, folder), ops.ImageOptions(steps=steps, **options)))


PIXELS = """
WITH base AS (SELECT vec_id, i // 8 AS y, i % 8 AS x, c,
 CAST(floor(least(1.0::DOUBLE, greatest(0.0::DOUBLE, embedding[(i + 21 * c) % 64 + 1]::DOUBLE + 0.5)) * 255) AS INTEGER) AS v
 FROM embeddings, (SELECT unnest(range(64)) AS i), (SELECT unnest([0, 1, 2]) AS c)),
k AS (SELECT unnest([-2, -1, 0, 1, 2]) AS d, unnest([1, 4, 6, 4, 1]) AS w)
"""

SUMS = """
SELECT vec_id, CAST(c AS INTEGER) AS c, CAST(sum(v) AS BIGINT) AS total, CAST(sum(v * (y * 8 + x + 1)) AS BIGINT) AS weighted
FROM {0} GROUP BY vec_id, c"""


@query("image_decode", PIXELS + """
SELECT vec_id % 10 AS label, CAST(c AS INTEGER) AS c, count(DISTINCT vec_id) AS pictures, CAST(sum(v) AS BIGINT) AS total,
 CAST(sum(v * (y * 8 + x + 1)) AS BIGINT) AS weighted FROM base GROUP BY 1, 2""")
def image_decode(spark, folder):
    """Bitmap files in class directories, decoded by the image source."""
    # Header of an 8x8 24-bit bitmap; rows are stored bottom-up.
    header = "424DF6000000000000003600000028000000080000000800000001001800000000" "00C0000000" + "00" * 16
    vectors = table(spark, folder, "embeddings")
    files = vectors.select(
        "vec_id",
        F.unhex(F.concat(F.lit(header), _bytes(lambda line: (SIDE - 1) - line))).alias("content"),
        (F.col("vec_id") % 10).alias("label"))
    target = scratch_path(spark, "bitmaps")
    # One file a row, as text with a newline that image decoders ignore: only this check needs such files.
    # Tasks grow with the rows and place their files themselves; the driver would move them one by one.
    tasks = max(8, -(-vectors.count() // FILES_PER_TASK))
    (files.repartition(tasks, "content", "vec_id").select(F.col("content").cast("string").alias("value"), "label")
     .write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy("label").text(target))
    found = images.with_class(images.scan_images(spark, target, ["txt"]), [str(i) for i in range(10)])
    weight = F.col("y") * SIDE + F.col("x") + 1
    sums = ops.pixel_table(found, ["label"]).groupBy("path", "label", "c").agg(
        F.sum("value").alias("total"), F.sum(F.col("value") * weight).alias("weighted"))
    return sums.groupBy(F.col("label").cast("bigint").alias("label"), "c").agg(
        F.count("*").alias("pictures"), F.sum("total").alias("total"), F.sum("weighted").alias("weighted"))


@query("image_mean", PIXELS + ", m AS (SELECT vec_id, y, x, c, CAST(floor(greatest(0, v - CASE c WHEN 0 THEN 103.94::DOUBLE "
       "WHEN 1 THEN 116.78::DOUBLE ELSE 123.68::DOUBLE END)) AS INTEGER) AS v FROM base)" + SUMS.format("m"))
def image_mean(spark, folder):
    return _step(spark, folder, "mean")


@query("image_equalize", PIXELS + """,
l AS (SELECT vec_id, y, x, (114 * max(v) FILTER (WHERE c = 0) + 587 * max(v) FILTER (WHERE c = 1)
 + 299 * max(v) FILTER (WHERE c = 2) + 500) // 1000 AS luma FROM base GROUP BY vec_id, y, x),
h AS (SELECT vec_id, luma, count(*) AS n FROM l GROUP BY vec_id, luma),
q AS (SELECT vec_id, luma, sum(n) OVER (PARTITION BY vec_id ORDER BY luma) AS upto,
 first_value(n) OVER (PARTITION BY vec_id ORDER BY luma) AS f FROM h),
t AS (SELECT vec_id, luma, CASE WHEN f = 64 THEN luma ELSE floor((upto - f) * 255.0::DOUBLE / (64 - f) + 0.5) END AS e FROM q),
z AS (SELECT b.vec_id, b.y, b.x, b.c, CAST(least(255, greatest(0, b.v + t.e - l.luma)) AS INTEGER) AS v
 FROM base b JOIN l ON l.vec_id = b.vec_id AND l.y = b.y AND l.x = b.x JOIN t ON t.vec_id = l.vec_id AND t.luma = l.luma)
""" + SUMS.format("z"))
def image_equalize(spark, folder):
    return _step(spark, folder, "equalize")


MIRROR = "CASE WHEN {0} < 0 THEN -({0}) WHEN {0} > 7 THEN 14 - ({0}) ELSE {0} END"


@query("image_blur", PIXELS + f""",
v1 AS (SELECT b.vec_id, b.y, b.x, b.c, sum(o.v * w) AS s FROM base b, k JOIN base o ON o.vec_id = b.vec_id AND o.c = b.c
 AND o.x = b.x AND o.y = {MIRROR.format('(b.y + d)')} GROUP BY ALL),
v2 AS (SELECT b.vec_id, b.y, b.x, b.c, CAST(floor(sum(o.s * w) / 256.0::DOUBLE + 0.5) AS INTEGER) AS v FROM v1 b, k JOIN v1 o
 ON o.vec_id = b.vec_id AND o.c = b.c AND o.y = b.y AND o.x = {MIRROR.format('(b.x + d)')} GROUP BY b.vec_id, b.y, b.x, b.c)
""" + SUMS.format("v2"))
def image_blur(spark, folder):
    return _step(spark, folder, "blur")


@query("image_opening", PIXELS + """,
e AS (SELECT b.vec_id, b.y, b.x, b.c, min(o.v) AS v FROM base b JOIN base o ON o.vec_id = b.vec_id AND o.c = b.c
 AND abs(o.y - b.y) <= 2 AND abs(o.x - b.x) <= 2 GROUP BY b.vec_id, b.y, b.x, b.c),
m AS (SELECT b.vec_id, b.y, b.x, b.c, max(o.v) AS v FROM e b JOIN e o ON o.vec_id = b.vec_id AND o.c = b.c
 AND abs(o.y - b.y) <= 2 AND abs(o.x - b.x) <= 2 GROUP BY b.vec_id, b.y, b.x, b.c)
""" + SUMS.format("m"))
def image_opening(spark, folder):
    return _step(spark, folder, "open")


@query("image_wavelet_edges", PIXELS + """,
z AS (SELECT vec_id, y, x, c, CAST(floor(greatest(0, v - avg(v) OVER (PARTITION BY vec_id, c, y // 2, x // 2))) AS INTEGER) AS v FROM base)
""" + SUMS.format("z"))
def image_wavelet_edges(spark, folder):
    return _step(spark, folder, "wavelet")


@query("image_wavelet_smooth", PIXELS + """,
z AS (SELECT vec_id, y, x, c, CAST(floor(avg(v) OVER (PARTITION BY vec_id, c, y // 2, x // 2)) AS INTEGER) AS v FROM base)
""" + SUMS.format("z"))
def image_wavelet_smooth(spark, folder):
    return _step(spark, folder, "wavelet", wavelet="smooth")


@query("image_features", PIXELS + """
SELECT vec_id, round(sum((v / 255.0::DOUBLE - 0.5) / 0.5), 3) AS total,
 round(sum((v / 255.0::DOUBLE - 0.5) / 0.5 * ((2 - c) * 64 + y * 8 + x + 1)), 1) AS weighted, count(*) AS n FROM base GROUP BY vec_id""")
def image_features(spark, folder):
    """Features at the pictures' own size: RGB planes scaled to [-1, 1]."""
    options = ops.ImageOptions(steps=(), feature_size=SIDE, keep_pixels=False)
    out = ops.preprocess(pictures(spark, folder), options)
    parts = out.select(F.col("path").cast("bigint").alias("vec_id"), F.posexplode("features").alias("i", "v"))
    return parts.groupBy("vec_id").agg(F.round(F.sum("v"), 3).alias("total"),
                                       F.round(F.sum(F.col("v").cast("double") * (F.col("i") + 1)), 1).alias("weighted"),
                                       F.count("*").alias("n"))


@query("image_resized_features", PIXELS + """,
taps AS (SELECT o, CAST(least(7, greatest(0, floor((o + 0.5) / 2 - 0.5) + t)) AS INTEGER) AS i,
 CASE t WHEN 0 THEN 1 - ((o + 0.5) / 2 - 0.5 - floor((o + 0.5) / 2 - 0.5)) ELSE (o + 0.5) / 2 - 0.5 - floor((o + 0.5) / 2 - 0.5) END AS w
 FROM (SELECT unnest(range(16))::DOUBLE AS o), (SELECT unnest([0, 1]) AS t)),
big AS (SELECT vec_id, c, a.o AS y, b.o AS x, floor(sum(v * a.w * b.w) + 0.5) AS v FROM base JOIN taps a ON a.i = base.y
 JOIN taps b ON b.i = base.x GROUP BY vec_id, c, a.o, b.o)
SELECT vec_id, round(sum((v / 255.0::DOUBLE - 0.5) / 0.5), 2) AS total,
 round(sum((v / 255.0::DOUBLE - 0.5) / 0.5 * ((2 - c) * 256 + y * 16 + x + 1)), 0) AS weighted, count(*) AS n FROM big GROUP BY vec_id""")
def image_resized_features(spark, folder):
    """Features at twice the pictures' size: bilinear resize, then scaling."""
    options = ops.ImageOptions(steps=(), feature_size=2 * SIDE, keep_pixels=False)
    out = ops.preprocess(pictures(spark, folder), options)
    parts = out.select(F.col("path").cast("bigint").alias("vec_id"), F.posexplode("features").alias("i", "v"))
    value = F.col("v").cast("double")
    return parts.groupBy("vec_id").agg(F.round(F.sum(value), 2).alias("total"),
                                       F.round(F.sum(value * (F.col("i") + 1)), 0).alias("weighted"),
                                       F.count("*").alias("n"))


@query("image_preprocess")
def image_preprocess(spark, folder):
    """Every step, random resize and colour jitter included."""
    options = ops.ImageOptions(short_edge=(16, 32), seed=7, feature_size=16, carry=("label",))
    out = ops.preprocess(pictures(spark, folder), options)
    return out.select(F.col("path").cast("bigint").alias("vec_id"), "label", "height", "width", "channels",
                      F.octet_length("data").alias("bytes"), F.size("features").alias("n_features"), "status")


@query("image_classifier")
def image_classifier(spark, folder):
    """Pictures to features, split, training and scored test rows in one job."""
    labelled = pictures(spark, folder).withColumnRenamed("label", "label_id")
    options = ops.ImageOptions(steps=("equalize",), feature_size=SIDE)
    return imagery.train_classifier(labelled, options)[1]
