"""Line protocol: ``measurement,tag=value field=value [seconds]``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Plain decimal text: one fraction digit at least, as many as needed, no exponent.
_DECIMAL = "0.0" + "#" * 339

# The characters escaped by a backslash in names, tag keys and tag values.
_ESCAPED = (" ", ",", "=")


def escape(text: Column) -> Column:
    for symbol in _ESCAPED:
        text = F.replace(text, F.lit(symbol), F.lit("\\" + symbol))
    return text


def decimal_text(value: Column) -> Column:
    # In this range a cast writes the same digits without an exponent, in a fraction of the time.
    size = F.abs(value)
    short = (value == 0) | ((size >= 1e-3) & (size < 1e7))
    return F.when(short, value.cast("string")).otherwise(F.call_function("format_number", value, F.lit(_DECIMAL)))


def _pairs(texts: Column, searched: list[Column], plain_values: bool) -> Column:
    """``key=value`` texts of a map of texts in key order, separated by commas.

    Searching each text three times for something to escape is most of the work, so
    it is done only in rows where ``searched`` holds any of it. Nothing keeps the map
    between two uses of it here, so each row uses it once: ``searched`` should be had
    without building it. ``plain_values`` says that values never hold anything to escape.
    """
    entries = F.sort_array(F.map_entries(texts))
    keep = lambda part: part

    def joined(key, value) -> Column:
        pairs = F.transform(entries, lambda e: F.concat(key(e["key"]), F.lit("="), value(e["value"])))
        return F.array_join(pairs, ",")

    escaping = joined(escape, keep if plain_values else escape)
    found = F.concat_ws("", *searched).rlike(f"[{''.join(_ESCAPED)}]")
    return F.when(found, escaping).otherwise(joined(keep, keep))


def encode_line(
    measurement: Column,
    tags: Column,
    fields: Column,
    seconds: Column,
    int_fields: Column | None = None,
) -> Column:
    """One line; tags and fields in key order, the time left out when NULL."""
    texts, names = F.transform_values(fields, lambda _, v: decimal_text(v)), [F.map_keys(fields)]
    if int_fields is not None:
        whole = F.transform_values(int_fields, lambda _, v: F.concat(v.cast("string"), F.lit("i")))
        texts, names = F.map_concat(texts, whole), [*names, F.map_keys(int_fields)]
    values = _pairs(texts, names, plain_values=True)
    tag_text = F.when(F.size(tags) > 0, _pairs(tags, [F.map_keys(tags), F.map_values(tags)], plain_values=False))
    return F.concat_ws(" ", F.concat_ws(",", escape(measurement), tag_text), values, seconds.cast("string"))


# Two-character codes for escaped symbols while a line is split; the first also
# codes itself, so a line may hold any character.
_CODE = "\x01"
_CODES = {"a": _CODE, "b": "\\ ", "c": "\\,", "d": "\\="}


def _coded(line: Column) -> Column:
    for code, escaped in _CODES.items():
        line = F.replace(line, F.lit(escaped), F.lit(_CODE + code))
    return line


def _decoded(text: Column) -> Column:
    for code, escaped in reversed(_CODES.items()):
        text = F.replace(text, F.lit(_CODE + code), F.lit(escaped.lstrip("\\")))
    return text


def parse_lines(rows: DataFrame) -> DataFrame:
    """Add measurement, tags, fields, int_fields and ts_s of each ``line``."""
    series, values = F.element_at("_parts", 1), F.try_element_at("_parts", F.lit(2))
    head = F.substring_index(series, ",", 1)
    tag_text = F.substr(series, F.length(head) + 2)
    split = (
        rows.withColumn("_coded", _coded(F.col("line")))
        .withColumn("_parts", F.split("_coded", " "))
        .withColumns(
            {
                "_head": head,
                "_tags": F.when(tag_text == "", F.create_map().cast("map<string,string>")).otherwise(
                    F.str_to_map(tag_text, F.lit(","), F.lit("="))
                ),
                "_values": F.str_to_map(values, F.lit(","), F.lit("=")),
            }
        )
    )

    def plain(texts: Column) -> Column:
        whole = F.map_from_arrays(
            F.transform(F.map_keys(texts), _decoded), F.transform(F.map_values(texts), _decoded)
        )
        return F.when(F.col("_coded").contains(_CODE), whole).otherwise(texts)

    parsed = split.withColumns({"_tags": plain(F.col("_tags")), "_values": plain(F.col("_values"))})
    kept = [name for name in rows.columns if name not in ("measurement", "tags", "fields", "int_fields", "ts_s")]
    doubles = F.map_filter("_values", lambda _, v: ~v.endswith("i"))
    whole = F.map_filter("_values", lambda _, v: v.endswith("i"))
    return parsed.select(
        *kept,
        _decoded(F.col("_head")).alias("measurement"),
        F.col("_tags").alias("tags"),
        F.transform_values(doubles, lambda _, v: v.try_cast("double")).alias("fields"),
        F.transform_values(whole, lambda _, v: F.rtrim(v, F.lit("i")).try_cast("bigint")).alias("int_fields"),
        F.try_element_at("_parts", F.lit(3)).try_cast("bigint").alias("ts_s"),
    )
