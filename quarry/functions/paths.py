"""Paths, names and numbers in text, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File name extensions of images and the layout of a dataset.
IMAGE_EXTENSIONS = ("bmp", "jpeg", "jpg", "png", "tif", "tiff", "webp")
DATASET = r"(?i)(images_cvat[^/\\]+_dataset)"
CALIBRATION_EXTENSIONS = (*IMAGE_EXTENSIONS, "ppm")
#: The parts of a path behind a dataset's folder, down to the image.
SIDE, SPLITS = "images", ("train", "val")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(c) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def normalize_slash(c) -> Column:
    return F.replace(_c(c), F.lit("\\"), F.lit("/"))


def normalize_list_path(c) -> Column:
    """A list file's path: no outer white space or quotes, forward slashes."""
    bare = F.btrim(F.btrim(strip(c), F.lit('"')), F.lit("'"))
    return normalize_slash(bare)


def swap_suffix(c, suffix: str = ".txt") -> Column:
    return F.regexp_replace(_c(c), r"\.[^./]*$", suffix)


def image_to_label_path(c) -> Column:
    """The right-most ``images`` folder becomes ``labels``; null without one."""
    c = _c(c)
    moved = F.regexp_replace(c, r"(?i)^(.*/|)images(/.*)$", "$1labels$2")
    return F.when(c.rlike(r"(?i)(^|/)images/"), swap_suffix(moved))


def label_of(relative, root: str) -> Column:
    return F.concat(F.lit(f"{root}/labels/"), swap_suffix(relative))


def label_to_images(c, extensions=IMAGE_EXTENSIONS) -> Column:
    """All image paths that a label may belong to."""
    stem = F.regexp_replace(_c(c), r"(?i)^(.*/|)labels(/.*)$", "$1images$2")
    return F.array(*(swap_suffix(stem, f".{e}") for e in extensions))


def extension(c) -> Column:
    return F.lower(F.regexp_extract(_c(c), r"\.([^./\\]+)$", 1))


def stem(c) -> Column:
    return F.regexp_replace(F.regexp_extract(_c(c), r"([^/\\]*)$", 1), r"(?<=.)\.[^.]*$", "")


def is_image(c, extensions=IMAGE_EXTENSIONS) -> Column:
    return extension(c).isin(*extensions)


def resolve_list_path(c, folder: str, absolute_exists: Column, relative_exists: Column) -> Column:
    """An existing path, else one in the list's folder, else what follows the
    left-most split marker (train before val), else the path in the folder."""
    c = _c(c)
    inside = F.concat(F.lit(f"{folder}/"), c)
    cut = lambda m: F.when(
        F.instr(F.lower(c), m) > 0, F.concat(F.lit(folder), F.substr(c, F.instr(F.lower(c), m)))
    )
    return F.coalesce(
        F.when(absolute_exists, c), F.when(relative_exists, inside), cut("/images/train/"), cut("/images/val/"), inside
    )


def _entry(c) -> Column:
    """struct(dataset, relative): the first folder named like a dataset with images and
    a split behind it, and what follows; null without one."""
    parts = F.filter(F.split(normalize_slash(c), "/"), lambda x: x != "")
    at = lambda i: F.lower(F.get(parts, i))
    is_entry = lambda x, i: (
        F.regexp_like(x, F.lit(f"{DATASET}$")) & (at(i + 1) == SIDE) & at(i + 2).isin(*SPLITS) & (F.size(parts) > i + 3)
    )
    places = F.filter(F.transform(parts, lambda x, i: F.when(is_entry(x, i), i)), lambda i: i.isNotNull())
    first = F.get(places, F.lit(0))
    name = F.regexp_extract(F.get(parts, first), f"{DATASET}$", 1)
    rest = F.array_join(F.slice(parts, first + 4, F.size(parts)), "/")
    return F.when(first.isNotNull(), F.struct(name.alias("dataset"), rest.alias("relative")))


def entry_dataset(c) -> Column:
    return _entry(c)["dataset"]


def entry_relative(c) -> Column:
    return _entry(c)["relative"]


def grouped_path(c, mode: str, root: str, custom_root: str | None = None) -> Column:
    """absolute, relative to ``root``, or under another root."""
    c = _c(c)
    relative = F.regexp_replace(c, f"^\\Q{root.rstrip('/')}/\\E", "")
    if mode == "absolute":
        return c
    if mode == "relative":
        return relative
    if mode == "custom_root" and custom_root:
        return F.concat(F.lit(custom_root.rstrip("/") + "/"), relative)
    raise ValueError(f"unknown path mode {mode!r}")


def rewrite_prefix(c, old: str, new: str) -> Column:
    """struct(path, changed): the prefix swapped whatever its case, at the start only."""
    path = normalize_slash(strip(c))
    old, new = old.replace("\\", "/"), new.replace("\\", "/")
    hit = F.startswith(F.lower(path), F.lit(old.lower()))
    return F.struct(
        F.when(hit, F.concat(F.lit(new), F.substr(path, F.lit(len(old) + 1)))).otherwise(path).alias("path"),
        hit.alias("changed"),
    )


def side_path(root: str, dataset, side: str, split, relative) -> Column:
    return F.concat_ws("/", F.lit(root), _c(dataset), F.lit(side), _c(split), _c(relative))


def output_path(root: str, keep_drop, category, relative) -> Column:
    return F.concat_ws("/", F.lit(root), _c(keep_drop), _c(category), _c(relative))


def safe_output_name(path, tags, order=("FN", "LOW_CONF", "LOW_IOU", "ANGLE_ERR", "FP")) -> Column:
    """Tags in a fixed order and the last four parts of the path, joined by __."""
    parts = F.split(_c(path), "/")
    last = F.slice(parts, F.greatest(F.size(parts) - 3, F.lit(1)), F.lit(4))
    named = F.array_intersect(F.array(*map(F.lit, order)), _c(tags))
    prefix = F.array_join(F.transform(named, lambda t: F.replace(t, F.lit("_"), F.lit(""))), "_")
    return F.concat_ws("__", F.when(prefix != "", prefix), F.array_join(last, "__"))


def source_dataset(path) -> Column:
    return F.try_element_at(F.split(_c(path), "/"), F.lit(-4))


def frame_name(video, save_index, frame_index, seconds) -> Column:
    return F.format_string(
        "%s_img_%06d_frame_%08d_time_%010.3fs.jpg", _c(video), _c(save_index), _c(frame_index), _c(seconds)
    )


def prediction_stem(index, path) -> Column:
    return F.concat(F.format_string("%06d_", _c(index)), stem(path))


def _by_value(digits: Column) -> Column:
    """Digits behind their number, so that longer runs sort after shorter ones."""
    return F.concat(F.lpad(F.length(digits).cast("string"), 6, "0"), digits)


def natural_key(c) -> Column:
    """An array that sorts digit runs by value and the rest in lower case."""
    marked = F.regexp_replace(F.lower(_c(c)), "([0-9]+)", "\u0001$1\u0001")
    return F.transform(
        F.split(marked, "\u0001"),
        lambda x, i: F.when(i % 2 == 1, _by_value(F.regexp_replace(x, "^0+(?=.)", ""))).otherwise(x),
    )


def numeric_key(c) -> Column:
    """Numeric stems first, by value, then the others by name."""
    digits = F.when(stem(c).rlike("^[0-9]+$"), stem(c).try_cast("bigint"))
    return F.struct(digits.isNull().alias("named"), digits.alias("value"), F.lower(_c(c)).alias("name"))


def fraction(c) -> Column:
    """"a/b" or a number as double; null if it is neither or b is 0."""
    parts = F.split(_c(c), "/")
    over = F.coalesce(F.get(parts, F.lit(1)), F.lit("1")).try_cast("double")
    return F.try_divide(F.get(parts, F.lit(0)).try_cast("double"), over)


def frame_rate(average, real) -> Column:
    usable = lambda x: F.when(_c(x) != "0/0", fraction(x))
    return F.coalesce(usable(average), usable(real))


def assembly_rate(source_rate, interval, manual=None) -> Column:
    automatic = _c(source_rate) / F.greatest(_c(interval), F.lit(1))
    return F.coalesce(F.lit(manual).cast("double"), automatic)


def duration(stream, container) -> Column:
    known = lambda x: F.nullif(_c(x), F.lit("N/A")).try_cast("double")
    return F.coalesce(known(stream), known(container))


def clock(seconds) -> Column:
    """HH:MM:SS, MM:SS under an hour, --:-- for nothing sensible."""
    s = _c(seconds).cast("long")
    hours, rest = F.floor(s / 3600).cast("long"), s % 3600
    tail = F.format_string("%02d:%02d", F.floor(rest / 60).cast("long"), rest % 60)
    return F.when(s.isNull() | (s < 0), F.lit("--:--")).when(
        hours > 0, F.concat(F.format_string("%02d:", hours), tail)
    ).otherwise(tail)


def joined_reasons(reasons, separator: str = " | ") -> Column:
    return F.array_join(F.filter(_c(reasons), lambda x: x.isNotNull()), separator)


def round_half_even(c, digits: int) -> Column:
    return F.bround(_c(c), digits)


def hash_keep(c, rate: float, seed) -> Column:
    """Keep a share of names, the same ones in every run."""
    if rate <= 0 or rate >= 1:
        return F.lit(rate >= 1)
    named = F.concat(F.lit(f"{seed}|"), normalize_slash(c))
    top = F.conv(F.substring(F.sha1(named.cast("binary")), 1, 16), 16, 10).cast("decimal(20,0)").cast("double")
    return top / F.lit(float(2**64 - 1)) < rate


def inference_size(mode: str, square: int = 960, rect: tuple[int, int] = (544, 960)) -> tuple[int, int]:
    """(height, width) of the model's input."""
    if mode == "square" and square > 0:
        return square, square
    if mode == "rect" and len(rect) == 2 and min(rect) > 0:
        return rect
    raise ValueError(f"no input size for mode {mode!r}")


def size_text(height, width) -> Column:
    return F.format_string("%d × %d", _c(height), _c(width))
