"""Documents that recognisers leave: read as tables, each with a table of violations instead of an error for the first one.

Every reader takes a path to JSON documents (one a file) and gives (rows, violations). A document with a wrong format or version gives no rows;
a row that breaks a rule is left out and told in violations (file, item, reason). `prefix` stands before the name of each format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnweave.functions import text as T

# Formats, behind the prefix that their producer gives them.
DETECTOR, TRANSCRIPT, EMBEDDING, CONTINUOUS, ALIGNMENT, BOUNDARIES = "detector-output", "transcript-output", "embedding-output", "continuous-asr-output", "forced-alignment-output", "utterance-boundary-output"
PREFIX = "speech"


def _documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return raw.select("file", F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("d"))


def _headed(docs: DataFrame, name: str, versions: list[int], *more: tuple[Column, str]) -> tuple[DataFrame, DataFrame]:
    """Documents of this format, and violations of the others; `more` are conditions that a document must not meet."""
    reason = F.when(F.col("d").isNull() | F.col("d._corrupt").isNotNull(), "no document of this form").when(~F.col("d.format").eqNullSafe(name), "unknown format")
    reason = reason.when(~F.coalesce(F.col("d.version").isin(versions), F.lit(False)), "unknown version")
    for broken, why in more:
        reason = reason.when(F.coalesce(broken, F.lit(False)), why)
    told = docs.withColumn("reason", reason)
    return told.where("reason is null").select("file", "d.*").drop("_corrupt"), told.where("reason is not null").select("file", F.lit(None).cast("bigint").alias("item"), "reason")


def _sorted_out(rows: DataFrame, reason: Column, bad: DataFrame) -> tuple[DataFrame, DataFrame]:
    told = rows.withColumn("reason", reason)
    return told.where("reason is null").drop("reason", "item", "file"), bad.union(told.where("reason is not null").select("file", F.col("item").cast("bigint"), "reason"))


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def detector_output(spark: SparkSession, path: str, prefix: str = PREFIX) -> tuple[DataFrame, DataFrame]:
    """Regions: detector, detector_model, detector_revision, detector_parameters (map), source_path, duration, start, end, label. A region must start at 0 or later, end
    after its start and not behind the source's end, if that is known."""
    schema = "format string, version int, detector struct<name:string,model:string,revision:string,parameters:map<string,string>>, source struct<path:string,sample_rate:int,channels:int,duration:double>, regions array<struct<start:double,end:double,label:string>>"
    docs, bad = _headed(_documents(spark, path, schema), f"{prefix}-{DETECTOR}", [1], (F.trim("d.detector.name") == "", "no detector"), (F.col("d.detector.name").isNull(), "no detector"), (F.col("d.source.path").isNull(), "no source"), (F.col("d.regions").isNull(), "no regions"))
    rows = docs.select("file", *(F.col(f"detector.{c}").alias("detector" if c == "name" else f"detector_{c}") for c in ("name", "model", "revision", "parameters")), F.col("source.path").alias("source_path"), F.col("source.duration").alias("duration"), F.posexplode("regions").alias("item", "r"))
    rows = rows.select("*", "r.*").drop("r")
    reason = F.when(~(_finite("start") & _finite("end")), "no range").when(F.col("start") < 0, "starts before 0").when(F.col("end") <= F.col("start"), "empty").when(F.col("end") > F.col("duration"), "ends behind its source")
    return _sorted_out(rows, reason, bad)


def transcript_output(spark: SparkSession, path: str, prefix: str = PREFIX) -> tuple[DataFrame, DataFrame]:
    """Hypotheses: transcriber, model, representation, region_id, text, language, confidence. A region twice in a document, no region, or a confidence
    that is no finite number: violations."""
    schema = "format string, version int, transcriber struct<name:string,model:string>, representation string, hypotheses array<struct<region_id:string,text:string,language:string,confidence:double>>"
    docs, bad = _headed(_documents(spark, path, schema), f"{prefix}-{TRANSCRIPT}", [1], (F.col("d.transcriber.name").isNull(), "no transcriber"), (F.col("d.representation").isNull(), "no representation"), (F.col("d.hypotheses").isNull(), "no hypotheses"))
    rows = docs.select("file", F.col("transcriber.name").alias("transcriber"), F.col("transcriber.model").alias("model"), "representation", F.posexplode("hypotheses").alias("item", "h")).select("*", "h.*").drop("h")
    rows = rows.withColumn("_n", F.count("*").over(Window.partitionBy("file", "region_id")))
    reason = F.when(F.coalesce(F.trim("region_id"), F.lit("")) == "", "no region").when(F.col("_n") > 1, "a region twice").when(F.col("confidence").isNotNull() & ~_finite("confidence"), "no confidence")
    good, bad = _sorted_out(rows, reason, bad)
    return good.drop("_n"), bad


def embedding_output(spark: SparkSession, path: str, prefix: str = PREFIX) -> tuple[DataFrame, DataFrame]:
    """Vectors: record_type (region or turn; region where nothing is said), encoder, model, revision, representation, id, vector. Each must be finite, of the dimension
    told and longer than 0; an id comes once."""
    schema = "format string, version int, record_type string, encoder struct<name:string,model:string,revision:string>, representation string, embeddings array<struct<region_id:string,turn_id:string,dimension:int,vector:array<double>>>"
    kind = F.coalesce("d.record_type", F.lit("region"))
    docs, bad = _headed(_documents(spark, path, schema), f"{prefix}-{EMBEDDING}", [1], (~kind.isin("region", "turn"), "unknown record type"), (F.col("d.encoder.name").isNull(), "no encoder"), (F.col("d.representation").isNull(), "no representation"), (F.col("d.embeddings").isNull(), "no embeddings"))
    rows = docs.select("file", F.coalesce("record_type", F.lit("region")).alias("record_type"), F.col("encoder.name").alias("encoder"), F.col("encoder.model").alias("model"), F.col("encoder.revision").alias("revision"), "representation", F.posexplode("embeddings").alias("item", "e")).select("*", "e.*").drop("e")
    rows = rows.withColumn("id", F.when(F.col("record_type") == "turn", F.col("turn_id")).otherwise(F.col("region_id"))).drop("turn_id", "region_id")
    rows = rows.withColumn("_n", F.count("*").over(Window.partitionBy("file", "id")))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    reason = (
        F.when(F.coalesce(F.trim("id"), F.lit("")) == "", "no id").when(F.col("_n") > 1, "an id twice").when(F.col("vector").isNull() | (F.size("vector") < 1), "no vector")
        .when(~F.coalesce(F.size("vector") == F.col("dimension"), F.lit(False)), "wrong dimension").when(~fine, "not finite")
    )
    good, bad = _sorted_out(rows, reason, bad)
    return good.drop("_n"), bad


WORD = "struct<text:string,start:double,end:double>"


def continuous_output(spark: SparkSession, path: str, prefix: str = PREFIX) -> tuple[DataFrame, DataFrame]:
    """Words of a whole recording: document (the file), language, word (number from 0), text, w_start, w_end. Version 1 has them flat; in version 2 they come in chunks,
    whose words' times count from the chunk's start. Chunks must be numbered from 0 without a gap and agree in their language; a word must not start
    before 0 or end before it starts."""
    schema = f"format string, version int, language string, text string, words array<{WORD}>, chunks array<struct<index:int,start:double,end:double,language:string,text:string,words:array<{WORD}>>>"
    chunks = F.col("d.chunks")
    numbered = F.forall(F.arrays_zip(F.transform(chunks, lambda c: c["index"]).alias("i"), F.sequence(F.lit(0), F.size(chunks) - 1).alias("k")), lambda x: x["i"] == x["k"])
    tongues = F.size(F.array_distinct(F.filter(F.transform(chunks, lambda c: c["language"]), lambda x: x.isNotNull())))
    two = F.col("d.version") == 2
    docs, bad = _headed(_documents(spark, path, schema), f"{prefix}-{CONTINUOUS}", [1, 2], (two & (chunks.isNull() | (F.size(chunks) < 1)), "no chunks"), (two & ~numbered, "chunks out of order"), (two & (tongues > 1), "several languages"), (~two & F.col("d.words").isNull(), "no words"))
    flat = F.transform("words", lambda w: F.struct(w["text"].alias("text"), w["start"].alias("w_start"), w["end"].alias("w_end")))
    moved = F.flatten(F.transform("chunks", lambda c: F.transform(c["words"], lambda w: F.struct(w["text"].alias("text"), (w["start"] + c["start"]).alias("w_start"), (w["end"] + c["start"]).alias("w_end")))))
    spoken = F.coalesce("language", F.try_element_at(F.filter(F.transform("chunks", lambda c: c["language"]), lambda x: x.isNotNull()), F.lit(1)))
    rows = docs.select("file", F.col("file").alias("document"), spoken.alias("language"), F.posexplode(F.when(F.col("version") == 2, moved).otherwise(flat)).alias("item", "w")).select("*", "w.*", F.col("item").cast("bigint").alias("word")).drop("w")
    reason = F.when(~(_finite("w_start") & _finite("w_end")), "no times").when(F.col("w_start") < 0, "starts before 0").when(F.col("w_end") < F.col("w_start"), "ends before it starts")
    return _sorted_out(rows, reason, bad)


def alignment_output(spark: SparkSession, path: str, prefix: str = PREFIX) -> tuple[DataFrame, DataFrame]:
    """Forced alignments: document, alignment (its number), language, word, text, w_start, w_end; of a document that holds one, or several in order of their
    index, numbered from 0 without a gap. The tokens of a text and of its words must be the same, all together."""
    one = f"language:string,text:string,words:array<{WORD}>"
    schema = f"format string, version int, {one.replace(':', ' ', 1).replace(',text:', ', text ').replace(',words:', ', words ')}, alignments array<struct<index:int,{one}>>"
    docs, bad = _headed(_documents(spark, path, schema), f"{prefix}-{ALIGNMENT}", [1], (F.col("d.words").isNull() & F.col("d.alignments").isNull(), "no alignment"))
    single = F.array(F.struct(F.lit(0).alias("index"), "language", "text", "words"))
    rows = docs.select("file", F.col("file").alias("document"), F.posexplode(F.coalesce("alignments", single)).alias("item", "a")).select("file", "document", "item", "a.*")
    letters = F.array_join(T.lexical_tokens(F.col("text")), "")
    spoken = F.array_join(F.flatten(F.transform("words", lambda w: T.lexical_tokens(w["text"]))), "")
    timed = F.forall("words", lambda w: (w["start"] >= 0) & (w["end"] >= w["start"]))
    reason = F.when(~F.col("index").eqNullSafe(F.col("item")), "out of order").when(F.col("words").isNull(), "no words").when(~F.coalesce(timed, F.lit(False)), "no times").when(letters != spoken, "other words than its text")
    told = rows.withColumn("reason", reason)
    good = told.where("reason is null").select("document", F.col("item").alias("alignment"), "language", F.posexplode("words").alias("word", "w")).select("document", "alignment", "language", "word", F.col("w.text").alias("text"), F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"))
    return good, bad.union(told.where("reason is not null").select("file", F.col("item").cast("bigint"), "reason"))


def boundary_output(spark: SparkSession, path: str, words: DataFrame | None = None, prefix: str = PREFIX) -> tuple[DataFrame, DataFrame]:
    """Sentence boundaries: document, word (the number of the word before each). Numbers must be those of words, each once; with `words` (document, n_words),
    the count told must be theirs."""
    docs, bad = _headed(_documents(spark, path, "format string, version int, word_count int, boundary_after_word_indices array<int>, segments array<string>"), f"{prefix}-{BOUNDARIES}", [1], (F.col("d.boundary_after_word_indices").isNull(), "no boundaries"))
    if words is not None:
        docs = docs.join(words.select(F.col("document").alias("file"), "n_words"), "file", "left")
        wrong = ~F.col("word_count").eqNullSafe(F.col("n_words").cast("int"))
        bad = bad.union(docs.where(wrong).select("file", F.lit(None).cast("bigint"), F.lit("other words than those told")))
        docs = docs.where(~wrong)
    rows = docs.select("file", F.col("file").alias("document"), "word_count", F.posexplode("boundary_after_word_indices").alias("item", "word"))
    rows = rows.withColumn("_first", F.min("item").over(Window.partitionBy("file", "word")))
    reason = F.when(~F.coalesce((F.col("word") >= 0) & (F.col("word") < F.col("word_count")), F.lit(False)), "no such word").when(F.col("_first") < F.col("item"), "a word twice")
    good, bad = _sorted_out(rows, reason, bad)
    return good.drop("_first", "word_count"), bad


def diarization_segments(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows, violations): start, end, speaker from lines of the three; a line of another shape, or without 0 <= start < end, is a violation."""
    parts = F.split(F.trim(column), r"\s+")
    at = lambda k: F.get(parts, F.lit(k))
    rows = lines.select("*", F.expr(f"try_cast(get(split(trim({column}), '\\\\s+'), 0) as double)").alias("start"), F.expr(f"try_cast(get(split(trim({column}), '\\\\s+'), 1) as double)").alias("end"), at(2).alias("speaker"), F.size(parts).alias("_n"))
    reason = F.when((F.col("_n") != 3) | F.col("start").isNull() | F.col("end").isNull(), "no segment").when((F.col("start") < 0) | (F.col("end") <= F.col("start")), "no range")
    told = rows.withColumn("reason", reason)
    return told.where("reason is null").drop("reason", "_n"), told.where("reason is not null").select(F.col(column).alias("line"), "reason")
