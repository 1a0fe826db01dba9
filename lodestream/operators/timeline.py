"""Spoken timelines, interval merging and render plans. Times are in seconds; sums are taken in whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAD_IN, TAIL, GAP_SENTENCE, GAP_ITEM = 600, 800, 150, 550
# Tolerances, in milliseconds.
MIN_SEG, CONTIGUOUS, TOTAL, AUDIO, FRAME = 150, 40, 50, 1, 60


def script(rows: DataFrame, group: str, item: str, order: list[str], text: str) -> DataFrame:
    """Adds ord (0 on, empty texts use none), si within the item and seg_id; one script for each group."""
    spoken = rows.where(F.trim(F.coalesce(text, F.lit(""))) != "")
    w = Window.partitionBy(group).orderBy(*order)
    numbered = spoken.withColumn("ord", F.row_number().over(w) - 1).withColumn("si", F.row_number().over(Window.partitionBy(group, item).orderBy(*order)) - 1)
    return numbered.withColumn("seg_id", F.format_string("%03d_%s_%d", F.col("ord").cast("int"), F.col(item).cast("string"), F.col("si").cast("int")))


def timeline(segs: DataFrame, group: str, item: str, order: str, dur_ms: str, lead_in: int = LEAD_IN, gap_sentence: int = GAP_SENTENCE, gap_item: int = GAP_ITEM) -> DataFrame:
    """Adds start_ms and end_ms: a running sum with gaps before sentences and before items; spans are runs of one item,
    numbered in span. The windows are within a group, an episode's segments."""
    w = Window.partitionBy(group).orderBy(order)
    before = F.lag(item).over(w)
    starts = F.row_number().over(w) == 1
    changed = segs.withColumn("_new", F.when(starts, 0).when(before.eqNullSafe(F.col(item)), 0).otherwise(1)).withColumn("_first", starts)
    gap = F.when(F.col("_first"), lead_in).when(F.col("_new") == 1, gap_item).otherwise(gap_sentence)
    up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timed = changed.withColumn("_gap", gap).withColumn("end_ms", F.sum(F.col("_gap") + F.col(dur_ms)).over(up_to))
    return timed.withColumn("start_ms", F.col("end_ms") - F.col(dur_ms)).withColumn("span", F.sum("_new").over(up_to)).drop("_new", "_first", "_gap")


def spans(timed: DataFrame, group: str, item: str) -> DataFrame:
    return timed.groupBy(group, "span").agg(F.first(item).alias(item), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))


def clock(ms: Column, comma: str = ",") -> Column:
    p = lambda x, n: F.lpad(F.floor(x).cast("string"), n, "0")
    return F.concat(p(ms / 3600000, 2), F.lit(":"), p(F.pmod(F.floor(ms / 60000), F.lit(60)), 2), F.lit(":"), p(F.pmod(F.floor(ms / 1000), F.lit(60)), 2), F.lit(comma), p(F.pmod(ms, F.lit(1000)), 3))


def subtitles(timed: DataFrame, group: str, order: str, text: str, vtt: bool = False) -> DataFrame:
    """group -> the SRT or VTT text of its segments."""
    mark = "." if vtt else ","
    times = F.concat(clock(F.col("start_ms"), mark), F.lit(" --> "), clock(F.col("end_ms"), mark), F.lit("\n"), F.col(text), F.lit("\n"))
    line = times if vtt else F.concat((F.col(order) + 1).cast("string"), F.lit("\n"), times)
    lines = F.array_sort(F.collect_list(F.struct(order, line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    return timed.groupBy(group).agg((F.concat(F.lit("WEBVTT\n\n"), body) if vtt else body).alias("subtitles"))


def merge_windows(windows: DataFrame, group: str, low: str, high: str, src: str | None = None, min_seg: int = MIN_SEG) -> DataFrame:
    """Windows clipped to [low, high), those under min_seg dropped, then merged where the gap is under min_seg; the
    first src of a merged window stays. start_ms and end_ms are in; gaps and islands within a group."""
    clipped = windows.withColumn("start_ms", F.greatest("start_ms", low)).withColumn("end_ms", F.least("end_ms", high)).where(F.col("end_ms") - F.col("start_ms") >= min_seg)
    w = Window.partitionBy(group).orderBy("start_ms", "end_ms")
    reach = F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))
    islands = clipped.withColumn("_new", F.when(reach.isNull() | (F.col("start_ms") - reach >= min_seg), 1).otherwise(0))
    islands = islands.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    more = [F.min_by(src, F.when(F.col(src).isNotNull(), F.struct("start_ms", "end_ms"))).alias(src)] if src else []
    return islands.groupBy(group, "island").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), *more)


def tile(spans_: DataFrame, group: str, total: str) -> DataFrame:
    """Each span shown until the next begins; the first from 0, the last to the total."""
    w = Window.partitionBy(group).orderBy("start_ms")
    first, nxt = F.row_number().over(w) == 1, F.lead("start_ms").over(w)
    return spans_.withColumns({"show_from": F.when(first, 0).otherwise(F.col("start_ms")), "show_to": F.coalesce(nxt, F.col(total))})


def tiling_faults(track: DataFrame, group: str, total: str, start: str = "show_from", end: str = "show_to", tolerance: int = CONTIGUOUS) -> DataFrame:
    """group, start, fault: holes or overlaps over the tolerance, segments without length, ends that miss 0 or total."""
    w = Window.partitionBy(group).orderBy(start)
    rows = track.withColumns({"_prev": F.lag(end).over(w), "_next": F.lead(start).over(w)})
    checks = F.array_compact(F.array(
        F.when(F.col("_prev").isNull() & (F.col(start) != 0), "first_not_zero"), F.when(F.abs(F.col(start) - F.col("_prev")) > tolerance, "seam"),
        F.when(F.col(end) <= F.col(start), "no_length"), F.when(F.col("_next").isNull() & (F.abs(F.col(end) - F.col(total)) > tolerance), "last_not_total"),
    ))
    return rows.select(group, F.col(start).alias("start"), F.explode(checks).alias("fault"))


def find_frame(wanted: DataFrame, frames: DataFrame, keys: list[str], at: str, tolerance: int = FRAME) -> DataFrame:
    """Each wanted row with the frame of its keys whose [t0, t1] holds it within the tolerance, the earliest; else the
    first existing frame of its keys."""
    rows = wanted.withColumn("_id", F.monotonically_increasing_id())
    met = rows.join(frames.select(*keys, F.col("t0").alias("_t0"), F.col("t1").alias("_t1"), F.col("path").alias("_path")), keys, "left")
    inside = F.col(at).between(F.col("_t0") - tolerance, F.col("_t1") + tolerance)
    rank = F.struct((~F.coalesce(inside, F.lit(False))).cast("int"), F.col("_t0"), F.col("_path"))
    best = met.groupBy("_id", *wanted.columns).agg(F.min(F.when(F.col("_path").isNotNull(), rank)).alias("_m"))
    return best.withColumn("frame", F.col("_m._path")).drop("_id", "_m")


def find_exact_frame(wanted: DataFrame, frames: DataFrame, keys: list[str], start: str, end: str, ord_: str, tolerance: int = FRAME) -> DataFrame:
    """Each wanted row with a frame of its keys: one whose t0 and t1 are both within the tolerance, the earliest path; else,
    where the untimed frames of the keys are as many as the wanted rows, the one at the row's place among them.

    frames: keys, t0, t1 (null where untimed), path, place.
    """
    w = Window.partitionBy(*keys)
    rows = wanted.withColumns({"_id": F.monotonically_increasing_id(), "_n": F.count("*").over(w)})
    timed = frames.where("t0 is not null").select(*keys, F.col("t0").alias("_t0"), F.col("t1").alias("_t1"), F.col("path").alias("_path"))
    near = (F.abs(F.col("_t0") - F.col(start)) <= tolerance) & (F.abs(F.col("_t1") - F.col(end)) <= tolerance)
    hit = rows.join(timed, keys, "left").groupBy("_id", "_n", *wanted.columns).agg(F.min(F.when(near, F.col("_path"))).alias("_hit"))
    loose = frames.where("t0 is null").select(*keys, F.col("path").alias("_loose"), (F.row_number().over(w.orderBy("place")) - 1).alias("_k"), F.count("*").over(w).alias("_m"))
    out = hit.withColumn("_k", F.col(ord_)).join(loose, [*keys, "_k"], "left")
    return out.withColumn("frame", F.coalesce("_hit", F.when(F.col("_m") == F.col("_n"), F.col("_loose")))).select(*wanted.columns, "frame")


def plan_faults(video: DataFrame, audio: DataFrame, segs: DataFrame, files: DataFrame, group: str, total: str, timeline_total: str) -> DataFrame:
    """group, fault, detail of a render plan: seams of its video track, totals apart by more than TOTAL, audio that misses
    its sentence by more than AUDIO or is missing or too much, and files that aren't there.

    video: group, show_from, show_to, src, total, timeline_total. audio: group, ord, at, src. segs: group, ord, start_ms.
    """
    seams = tiling_faults(video, group, total).select(group, "fault", F.col("start").cast("string").alias("detail"))
    apart = video.select(group, total, timeline_total).distinct().where(F.abs(F.col(total) - F.col(timeline_total)) > TOTAL).select(group, F.lit("total"), F.col(total).cast("string"))
    met = audio.select(group, "ord", "at").join(segs.select(group, "ord", F.col("start_ms").alias("_s")), [group, "ord"], "full_outer")
    late = met.where(F.col("at").isNull() | F.col("_s").isNull() | (F.abs(F.col("at") - F.col("_s")) > AUDIO)).select(group, F.lit("audio"), F.col("ord").cast("string"))
    named = video.select(group, "src").union(audio.select(group, "src")).where("src <> ''").distinct()
    gone = named.join(files.select(F.col("path").alias("src")), "src", "left_anti").select(group, F.lit("file"), "src")
    return seams.union(apart).union(late).union(gone)


def shot_frame(explicit: Column, found: Column, item: Column, files: Column) -> Column:
    """The file of a shot: the one that it names, if that is there, else the frame that was found, else the one that is
    named after its item, if that is there."""
    usual = F.concat(F.lit("shots/"), item, F.lit(".png"))
    return F.coalesce(F.when(F.array_contains(files, explicit), explicit), found, F.when(F.array_contains(files, usual), usual))


def last_known(rows: DataFrame, group: str, order: str, column: str) -> DataFrame:
    """A null filled by the last value before it in its group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(column, F.last(column, ignorenulls=True).over(w))


def ffconcat(track: DataFrame, group: str) -> DataFrame:
    """group -> a concat demuxer's text; the last file comes twice."""
    quoted = F.concat(F.lit("file '"), F.replace("src", F.lit("'"), F.lit("'\\''")), F.lit("'"))
    line = F.struct("show_from", quoted.alias("file"), F.format_string("duration %.3f", (F.col("show_to") - F.col("show_from")) / 1000).alias("dur"))
    rows = F.array_sort(F.collect_list(line))
    body = F.array_join(F.flatten(F.transform(rows, lambda x: F.array(x["file"], x["dur"]))), "\n")
    return track.groupBy(group).agg(F.concat(F.lit("ffconcat version 1.0\n"), body, F.lit("\n"), F.element_at(F.transform(rows, lambda x: x["file"]), -1), F.lit("\n")).alias("text"))


def shot_windows(overlays: DataFrame, issue: DataFrame, segs: DataFrame) -> DataFrame:
    """item, start_ms, end_ms, src of shots: the timeline's own overlays of kind shot; for items without one, the window
    from the first to the last sentence that the issue names (item, first, last), if the item has them.

    segs: item, si (from 0), start_ms, end_ms.
    """
    own = overlays.where(F.coalesce("kind", F.lit("shot")) == "shot").where("start_ms is not null and end_ms is not null").select("item", "start_ms", "end_ms", "src")
    rest = issue.join(own.select("item").distinct(), "item", "left_anti").where("first >= 1 and last >= 1")
    a = segs.select("item", (F.col("si") + 1).alias("first"), F.col("start_ms").alias("start_ms"))
    b = segs.select("item", (F.col("si") + 1).alias("last"), F.col("end_ms").alias("end_ms"))
    return own.unionByName(rest.join(a, ["item", "first"]).join(b, ["item", "last"]).select("item", "start_ms", "end_ms", F.lit(None).cast("string").alias("src")))


def any_card(frames: DataFrame, group: str) -> DataFrame:
    """group, path: the first card that there is, by item and place."""
    return frames.where("kind = 'card' and path is not null").groupBy(group).agg(F.min_by("path", F.struct("item", "place")).alias("path"))
