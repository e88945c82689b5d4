"""Reference tables: genes, transcripts, variations, name dictionaries, sequences, and detection datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeflow.functions import text as T
from lodeflow.operators import keyed

HUMAN = "9606"


def _tsv(spark: SparkSession, path: str, columns: int = 16) -> DataFrame:
    """Tab-separated, compressed or not; columns _c0, _c1, ..., null where a line has fewer."""
    return spark.read.option("sep", "\t").option("quote", "").schema(", ".join(f"_c{i} string" for i in range(columns))).csv(path)


def genes(spark: SparkSession, path: str, tax: str | None = None) -> DataFrame:
    """id, symbol, chrom from a gene table with a comment header."""
    raw = _tsv(spark, path).where(~F.col("_c0").startswith("#"))
    if tax:
        raw = raw.where(F.col("_c0") == tax)
    return raw.select(F.col("_c1").cast("int").alias("id"), F.col("_c2").alias("symbol"), F.col("_c6").alias("chrom"))


def gene_symbols(spark: SparkSession, path: str, tax: str = HUMAN) -> DataFrame:
    """Cleaned symbols and synonyms of one species with their gene: key, gene_id; a key of several genes takes the greatest id."""
    raw = _tsv(spark, path).where(F.col("_c0") == tax)
    names = F.concat(F.array("_c2"), F.when(F.col("_c4") != "-", F.split("_c4", r"\|")).otherwise(F.array().cast("array<string>")))
    return raw.select(F.explode(names).alias("n"), F.col("_c1").cast("int").alias("gene_id")).groupBy(T.upper_key(F.col("n")).alias("key")).agg(F.max("gene_id").alias("gene_id")).where("key <> ''")


def rsids(spark: SparkSession, path: str) -> DataFrame:
    """name (number), chrom, start, end, ref, observed; rows whose name isn't rs and a number are left out."""
    raw = _tsv(spark, path).where(F.col("_c4").rlike("^rs[0-9]+$"))
    return raw.select(F.substring("_c4", F.lit(3), F.length("_c4")).cast("bigint").alias("name"), F.col("_c1").alias("chrom"), F.col("_c2").cast("bigint").alias("start"), F.col("_c3").cast("bigint").alias("end"), F.col("_c7").alias("ref"), F.col("_c9").alias("observed"))


def transcript_rows(spark: SparkSession, path: str) -> DataFrame:
    raw = _tsv(spark, path).where(~F.col("_c0").startswith("#"))
    return raw.select(T.accession(F.col("_c1")).alias("name"), F.col("_c2").alias("chrom"), F.when(F.col("_c3") == "+", 1).otherwise(-1).alias("strand"), *[F.col(f"_c{4 + i}").cast("bigint").alias(n) for i, n in enumerate(("tx_start", "tx_end", "cds_start", "cds_end"))], T.int_list(F.col("_c9")).alias("exon_starts"), T.int_list(F.col("_c10")).alias("exon_ends"))


def alias_map(spark: SparkSession, path: str, symbols: DataFrame) -> DataFrame:
    """name, gene_id of a white-space separated list of transcript names and gene names."""
    parts = F.split(F.trim("value"), r"\s+")
    raw = spark.read.text(path).select(T.accession(parts[0]).alias("name"), T.upper_key(F.try_element_at(parts, F.lit(2))).alias("key"))
    return raw.join(symbols, "key").select("name", "gene_id")


def refseq_map(spark: SparkSession, path: str, tax: str = HUMAN) -> DataFrame:
    raw = _tsv(spark, path).where((F.col("_c0") == tax) & (F.col("_c3") != "-"))
    return raw.select(T.accession(F.col("_c3")).alias("name"), F.col("_c1").cast("int").alias("gene_id"))


def transcripts(rows: list[DataFrame], maps: list[DataFrame]) -> DataFrame:
    """Transcripts of several tables with their gene; later maps overwrite earlier ones, names without a gene go, (name, chrom) is unique."""
    gene = keyed.merge_last(maps, ["name"], ["gene_id"])
    both = None
    for r in rows:
        both = r if both is None else both.unionByName(r)
    found = both.join(gene, "name").withColumn("is_coding", F.col("cds_start") != F.col("cds_end"))
    one = Window.partitionBy("name", "chrom").orderBy("tx_start", "tx_end", F.to_json("exon_starts"))
    return found.withColumn("__r", F.row_number().over(one)).where("__r = 1").drop("__r")


def fasta(spark: SparkSession, path: str, name: str = "chrom") -> DataFrame:
    """chrom, start0, line of sequence files. Lines are numbered within each split of a file; only one row for each split (its last header, its bases) meets in one place to carry on.

    ``sequence.sequence_chunks`` reads ranges of one file without going through all of it.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).withColumn("n", F.monotonically_increasing_id())
    is_head, line = F.col("value").startswith(">"), F.trim("value")
    lines = raw.select("file", "block", "n", F.when(is_head, F.regexp_extract("value", r"^>(\S+)", 1)).alias("head"), line.alias("line"), F.when(is_head, 0).otherwise(F.length(line)).alias("size"))
    own = Window.partitionBy("file", "block").orderBy("n")
    lines = lines.withColumn("before", F.coalesce(F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    mark = F.last(F.when(F.col("head").isNotNull(), F.struct("head", "before")), True).over(own.rowsBetween(Window.unboundedPreceding, 0))
    lines = lines.withColumn("mark", mark)
    splits = lines.groupBy("file", "block").agg(F.sum("size").alias("total"), F.max_by("mark", "n").alias("last"))
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("base", F.coalesce(F.sum("total").over(order), F.lit(0))).withColumn("at", F.when(F.col("last").isNotNull(), F.struct(F.col("last.head").alias("head"), (F.col("base") + F.col("last.before")).alias("place"))))
    carried = splits.select("file", "block", "base", F.last("at", True).over(order).alias("carried"))
    told = lines.join(carried, ["file", "block"]).where("head is null and line <> ''")
    start = F.when(F.col("mark").isNotNull(), F.col("before") - F.col("mark.before")).otherwise(F.col("base") + F.col("before") - F.col("carried.place"))
    return told.select(F.coalesce("mark.head", "carried.head").alias(name), start.alias("start0"), "line")


def name_dictionary(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Names by kind, tokens by gene and by name, of a csv with gene_id, symbol, synonyms, full_name, other_names."""
    raw = spark.read.option("header", "true").csv(path).withColumn("gene_id", F.col("gene_id").cast("int"))
    def listed(col):
        return F.when(F.col(col).isNull() | (F.col(col) == "-"), F.array().cast("array<string>")).otherwise(F.split(F.col(col), r"\|"))
    kinds = F.array(F.struct(F.lit("symbol").alias("kind"), F.array("symbol").alias("names")), F.struct(F.lit("synonym").alias("kind"), listed("synonyms").alias("names")), F.struct(F.lit("other").alias("kind"), F.concat(listed("full_name"), listed("other_names")).alias("names")))
    flat = raw.select("gene_id", F.explode(kinds).alias("k")).select("gene_id", "k.kind", F.explode("k.names").alias("name")).where("name <> '' and name <> '-'")
    words = flat.select("gene_id", "name", F.explode(F.split(T.name_words(F.col("name")), " +")).alias("token")).where("token <> ''")
    return {"names": flat.select("kind", T.name_key(F.col("name")).alias("name_key"), "gene_id").distinct(), "gene_tokens": words.select("gene_id", "token").distinct(), "name_tokens": words.distinct()}


def tree(spark: SparkSession, path: str) -> DataFrame:
    """path, token, gene_id of a prefix tree file (a byte-order mark in front doesn't count)."""
    raw = _tsv(spark, path)
    return raw.select(F.regexp_replace("_c0", "^\ufeff", "").alias("path"), F.col("_c1").alias("token"), F.col("_c2").cast("int").alias("gene_id"))


def line_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("line")).where("line <> ''").distinct()


def coco(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """images, annotations, categories of an annotation file."""
    raw = spark.read.option("multiLine", "true").json(path)
    out = {}
    for part in ("images", "annotations", "categories"):
        if part in raw.columns:
            out[part] = raw.select(F.explode(part).alias("x")).select("x.*")
    return out


def coco_results(spark: SparkSession, path: str, images: DataFrame) -> DataFrame:
    """Detections of a result file with unique ids; an image that isn't in the set is an error."""
    raw = spark.read.option("multiLine", "true").json(path)
    extra = raw.select(F.col("image_id").alias("id")).distinct().join(images.select("id"), "id", "left_anti").limit(1).collect()
    if extra:
        raise ValueError(f"results name an unknown image: {extra[0][0]}")
    b = F.col("bbox")
    return raw.withColumn("id", F.monotonically_increasing_id() + 1).select("id", "image_id", "category_id", "score", b[0].alias("x1"), b[1].alias("y1"), (b[0] + b[2]).alias("x2"), (b[1] + b[3]).alias("y2"), (b[2] * b[3]).alias("area"))


def annotation_filter(anns: DataFrame, images: list | None = None, categories: list | None = None, area: tuple[float, float] | None = None, crowd: bool | None = None) -> DataFrame:
    """Annotations by image, category, open range of area, crowd flag; what isn't given doesn't filter."""
    out = anns
    if images:
        out = out.where(F.col("image_id").isin(images))
    if categories:
        out = out.where(F.col("category_id").isin(categories))
    if area:
        out = out.where((F.col("area") > area[0]) & (F.col("area") < area[1]))
    if crowd is not None:
        out = out.where(F.col("iscrowd") == int(crowd))
    return out


def category_filter(cats: DataFrame, names: list | None = None, supers: list | None = None, ids: list | None = None) -> DataFrame:
    out = cats
    for col, values in (("name", names), ("supercategory", supers), ("id", ids)):
        if values:
            out = out.where(F.col(col).isin(values))
    return out


def coco_boxes(anns: DataFrame, images: DataFrame) -> DataFrame:
    """Sane boxes of annotations: clipped to the image, with some area; overlap 1, or -1 for crowds."""
    b = F.col("bbox")
    x1, y1 = F.greatest(b[0], F.lit(0.0)), F.greatest(b[1], F.lit(0.0))
    j = anns.join(images.select(F.col("id").alias("image_id"), "width", "height"), "image_id")
    out = j.select("image_id", "category_id", "area", x1.alias("x1"), y1.alias("y1"), F.least(F.col("width") - 1.0, x1 + F.greatest(b[2] - 1, F.lit(0.0))).alias("x2"), F.least(F.col("height") - 1.0, y1 + F.greatest(b[3] - 1, F.lit(0.0))).alias("y2"), F.when(F.col("iscrowd") == 1, -1.0).otherwise(1.0).alias("overlap"))
    return out.where("area > 0 and x2 >= x1 and y2 >= y1")


def voc(spark: SparkSession, path: str, keep_difficult: bool = True) -> DataFrame:
    """Objects of annotation files: image, object, name, difficult, truncated and a box that starts at 0."""
    kind = "filename string, object array<struct<name:string,pose:string,truncated:int,difficult:int,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>"
    raw = spark.read.format("xml").option("rowTag", "annotation").schema(kind).load(path)
    o = raw.select(F.regexp_replace("filename", r"\.[^.]*$", "").alias("image"), F.posexplode("object").alias("object", "o"))
    out = o.select("image", "object", "o.name", F.coalesce("o.difficult", F.lit(0)).alias("difficult"), F.coalesce("o.truncated", F.lit(0)).alias("truncated"), *[(F.col(f"o.bndbox.{c}") - 1).alias(n) for c, n in (("xmin", "x1"), ("ymin", "y1"), ("xmax", "x2"), ("ymax", "y2"))])
    return out if keep_difficult else out.where("difficult = 0")


def scene_graph(spark: SparkSession, path: str, objects: DataFrame, attributes: DataFrame, relations: DataFrame, sizes: DataFrame) -> dict[str, DataFrame]:
    """Objects with a class of the vocabulary (synonyms share one), at most 16 attributes, boxes clipped to the image, and distinct
    relations between kept objects. Vocabularies: name, id."""
    kind = "filename string, object array<struct<object_id:bigint,name:string,attribute:array<string>,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>, relation array<struct<subject_id:bigint,predicate:string,object_id:bigint>>"
    raw = spark.read.format("xml").option("rowTag", "annotation").schema(kind).load(path).select(F.regexp_replace("filename", r"\.[^.]*$", "").alias("image"), "object", "relation")
    o = raw.select("image", F.explode("object").alias("o")).select("image", "o.*").join(objects.select("name", F.col("id").alias("class")), "name").join(sizes, "image")
    w, h, b = F.col("width"), F.col("height"), "bndbox."
    boxed = o.select("image", "object_id", "class", "attribute", F.greatest(F.lit(0.0), F.col(b + "xmin")).alias("x1"), F.greatest(F.lit(0.0), F.col(b + "ymin")).alias("y1"), F.least(w - 1.0, F.col(b + "xmax")).alias("x2"), F.least(h - 1.0, F.col(b + "ymax")).alias("y2")).where("x2 >= x1 and y2 >= y1")
    atts = boxed.select("image", "object_id", F.posexplode("attribute").alias("i", "name")).join(attributes.select("name", F.col("id").alias("att")), "name").groupBy("image", "object_id").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("i", "att"))), lambda x: x["att"]), 1, 16).alias("attributes"))
    kept = boxed.drop("attribute").join(atts, ["image", "object_id"], "left")
    ids = kept.select("image", "object_id")
    r = raw.select("image", F.explode("relation").alias("r")).select("image", "r.*").join(relations.select(F.col("name").alias("predicate"), F.col("id").alias("rel")), "predicate")
    r = r.join(ids.withColumnRenamed("object_id", "subject_id"), ["image", "subject_id"]).join(ids, ["image", "object_id"]).select("image", "subject_id", "rel", "object_id").distinct()
    return {"objects": kept, "relations": r}


def detections(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``image score x1 y1 x2 y2``."""
    return spark.read.option("sep", " ").schema("image string, score double, x1 double, y1 double, x2 double, y2 double").csv(path)


#: Datasets by name: functions of a session and a path.
DATASETS: dict = {"voc": voc, "voc_no_difficult": lambda s, p: voc(s, p, False), "coco": coco, "detections": detections}


def dataset(name: str):
    if name not in DATASETS:
        raise KeyError(f"unknown dataset: {name}")
    return DATASETS[name]
