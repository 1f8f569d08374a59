"""Recordings and their forms: time mapping, choice of a form by name or purpose, choice of an audio stream.

A recording's forms are a map from name to struct<path, kind, purposes array<string>, duration, media_start, stream_index, channel_mode, ...>.
Expressions give null where the reference data can't give an answer; `problem` columns say why.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnweave.functions.intervals import near_source_edge

# Channel layouts with a centre channel.
CENTRE_LAYOUTS = r"^(?:5\.1|7\.1)"


def media_start(form: Column) -> Column:
    """Where a form begins in the original; null where that isn't known or is negative."""
    return F.when(form["media_start"] >= 0, form["media_start"])


def to_media_time(form: Column, time: Column) -> Column:
    return F.when(time >= 0, time + media_start(form))


def from_media_time(form: Column, time: Column) -> Column:
    """Null before the form's beginning."""
    return F.when((time >= 0) & (time >= media_start(form)), time - media_start(form))


def form_named(forms: Column, name: Column | str) -> Column:
    return F.try_element_at(forms, F.lit(name) if isinstance(name, str) else name)


def forms_for(forms: Column, purpose: str) -> Column:
    """The entries (key, value) of the forms that serve a purpose, by name."""
    return F.array_sort(F.filter(F.map_entries(forms), lambda e: F.coalesce(F.array_contains(e["value"]["purposes"], purpose), F.lit(False))))


def only_form_for(forms: Column, purpose: str) -> Column:
    """The entry of the one form that serves a purpose; null if none or several do."""
    found = forms_for(forms, purpose)
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def first_form_for(forms: Column, purpose: str) -> Column:
    return F.try_element_at(forms_for(forms, purpose), F.lit(1))


def form_problems(sources: DataFrame, purpose: str, required: bool = True) -> DataFrame:
    """Adds problem: 'none' (if one is required) or 'several' forms serve the purpose, null if one does."""
    n = F.coalesce(F.size(forms_for(F.col("forms"), purpose)), F.lit(0))
    return sources.withColumn("problem", F.when(n > 1, "several").when((n < 1) & F.lit(required), "none"))


def has_media_mapping(form: Column) -> Column:
    return form["media_start"].isNotNull() & form["stream_index"].isNotNull() & form["channel_mode"].isNotNull()


def boundary_evidence(turns: DataFrame, sources: DataFrame, purpose: str = "boundary_analysis", margin: float = 0.1) -> DataFrame:
    """Adds form, near_start, near_end and problem to turns (source_id, source_start, source_end) from the one form of their source (id, forms) that
    serves the purpose; nulls where there is none. Problems: 'several' forms, 'no duration', 'no range', 'beyond the end'."""
    chosen = sources.select(F.col("id").alias("source_id"), only_form_for(F.col("forms"), purpose).alias("_f"), F.size(forms_for(F.col("forms"), purpose)).alias("_n"))
    out = turns.join(chosen, "source_id", "left")
    duration = F.col("_f.value.duration")
    problem = (
        F.when(F.col("_n") > 1, "several").when(F.col("_f").isNotNull() & duration.isNull(), "no duration")
        .when((F.col("source_start") < 0) | (F.col("source_end") <= F.col("source_start")), "no range").when(F.col("source_end") > duration, "beyond the end")
    )
    start, end = near_source_edge(F.col("source_start"), F.col("source_end"), duration, margin)
    out = out.withColumns({"form": F.col("_f.key"), "problem": problem})
    fine = F.col("problem").isNull() & F.col("form").isNotNull()
    return out.withColumns({"near_start": F.when(fine, start), "near_end": F.when(fine, end)}).drop("_f", "_n")


def with_form(sources: DataFrame, new: DataFrame) -> DataFrame:
    """Sources with forms added that are made from another: `new` has id, name, parent and form (a struct like the map's values), which takes media_start,
    stream_index and channel_mode from its parent. A form that is there already stays as it is."""
    kind = sources.schema["forms"].dataType.valueType
    both = new.join(sources.select("id", F.col("forms").alias("_all")), "id")
    parent = form_named(F.col("_all"), F.col("parent"))
    inherited = {"media_start", "stream_index", "channel_mode"}
    made = F.struct(*((parent[f.name] if f.name in inherited else F.col(f"form.{f.name}")).cast(f.dataType).alias(f.name) for f in kind.fields))
    fresh = both.where(parent.isNotNull() & form_named(F.col("_all"), F.col("name")).isNull()).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("name", made))).alias("_new"))
    out = sources.join(fresh, "id", "left")
    return out.select(*(F.when(F.col("_new").isNull(), F.col("forms")).otherwise(F.map_concat("forms", "_new")).alias("forms") if c == "forms" else F.col(c) for c in sources.columns))


def set_provenance(sources: DataFrame, changes: DataFrame) -> DataFrame:
    """Sources with media_start, stream_index and channel_mode of one form (id, name, and the three) replaced."""
    told = sources.join(changes.select("id", "name", F.struct("media_start", "stream_index", "channel_mode").alias("_new")), "id", "left")
    new = F.transform_values("forms", lambda k, v: F.when(k == F.col("name"), v.withField("media_start", F.col("_new.media_start")).withField("stream_index", F.col("_new.stream_index")).withField("channel_mode", F.col("_new.channel_mode"))).otherwise(v))
    return told.select(*(F.when(F.col("_new").isNull(), F.col("forms")).otherwise(new).alias("forms") if c == "forms" else F.col(c) for c in sources.columns))


def without_form(records: DataFrame, form: str) -> DataFrame:
    """Records whose clip of a form is cut anew: transcripts and embeddings made from it (maps of structs with `representation`) go."""
    kept = lambda c: F.map_filter(c, lambda _, v: ~v["representation"].eqNullSafe(F.lit(form)))
    return records.withColumns({"transcripts": kept("transcripts"), "embeddings": kept("embeddings")})


def stale_clips(records: DataFrame, clips: DataFrame) -> DataFrame:
    """Records (id, source_start, source_end) whose clip (id, clip_start, clip_end) is missing or of another range: the work list. Clips wider than their
    record, by padding, do."""
    both = records.join(clips.select("id", "clip_start", "clip_end"), "id", "left")
    fine = (F.col("clip_start") <= F.col("source_start")) & (F.col("clip_end") >= F.col("source_end"))
    return both.where(~F.coalesce(fine, F.lit(False))).drop("clip_start", "clip_end")


def channel_mode(layout: Column) -> Column:
    return F.when(layout.rlike(CENTRE_LAYOUTS), "center").otherwise("mono")


def choose_stream(streams: DataFrame, requests: DataFrame) -> DataFrame:
    """source, stream_index and rule, or problem: of each source's streams (source, stream_index, language, is_default) the one asked for (requests:
    source, stream_index, language), else the only one of the language asked for, else the only default one, else the only one."""
    both = requests.select("source", F.col("stream_index").alias("_i"), F.lower("language").alias("_l")).join(streams, "source", "left")
    ids = lambda when: F.collect_list(F.when(when, F.col("stream_index")))
    got = both.groupBy("source", "_i", "_l").agg(ids(F.col("stream_index") == F.col("_i")).alias("a"), ids(F.lower("language") == F.col("_l")).alias("b"), ids(F.col("is_default")).alias("c"), ids(F.lit(True)).alias("d"))
    one = lambda c: F.size(c) == 1
    rule = F.when(F.col("_i").isNotNull(), F.when(one("a"), "asked")).when(one("b"), "language").when(one("c"), "default").when(one("d"), "only")
    at = lambda c: F.try_element_at(c, F.lit(1))
    chosen = F.when(rule == "asked", at("a")).when(rule == "language", at("b")).when(rule == "default", at("c")).when(rule == "only", at("d"))
    return got.select("source", chosen.alias("stream_index"), rule.alias("rule"), F.when(rule.isNull(), F.when(F.size("d") < 1, "no stream").when(F.col("_i").isNotNull(), "no such stream").otherwise("ambiguous")).alias("problem"))


def compatible(stored: DataFrame, asked: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """key and state of each asked-for result: 'absent', 'same' (a stored one has equal fields, or none recorded: it is older than they are) or 'conflict'."""
    held = stored.select(*key, F.struct(*fields).alias("_s"), F.coalesce(*(F.col(f).cast("string") for f in fields)).isNull().alias("_old"))
    both = asked.select(*key, F.struct(*fields).alias("_a")).join(held, key, "left")
    state = F.when(F.col("_s").isNull(), "absent").when(F.col("_old") | F.col("_s").eqNullSafe(F.col("_a")), "same").otherwise("conflict")
    return both.select(*key, state.alias("state"))
