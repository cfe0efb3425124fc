"""License scans in DataFrame operations only.

Every line of every file is compared with license notices by the cosine of sparse TF-IDF vectors, whole
texts and not only their tops. A file's own license is its best line's. Files without one inherit that of the
nearest directory above them which holds a license file.

Weights: ``tf * ln((1 + lines) / (1 + lines with the term))`` over all lines of all files, for every term of
every line. A line that shares too little weight with each template to reach the bound, whatever else it
holds, is never brought to the templates; the weights of all terms are joined to the others.

Cases: null texts have no lines, null paths lie in no directory and inherit nothing. Equal cosines go to the
template first in order; among license files of one directory the best cosine, then the first path, counts. Rows
repeated give equal rows. Only ``path``, ``text`` and the named key columns are looked at.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.runtime import materialize

LEAST_COSINE = 0.6
#: Short notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
TERM = r"[a-z0-9][-a-z0-9+]*(?:\.[0-9]+)*"
LICENSE_FILE = r"(?i)^(?:licen[cs]e|copying|notice)(?:[-.][^/]*)?$"


def terms(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0))


def template_terms(templates: dict[str, str]) -> dict[str, dict[str, int]]:
    """Term counts of each template; a bounded table, given by the caller."""
    out = {}
    for name, text in templates.items():
        found = re.findall(TERM, text.lower())
        out[name] = {t: found.count(t) for t in sorted(set(found))}
    return out


def _number(table: dict[str, float], term: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), term)


def scan(files: DataFrame, keys: list[str], templates: dict[str, str] = TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """``keys``, ``license`` and ``cosine`` of the files that hold a license line."""
    counted = template_terms(templates)
    vocabulary = sorted({t for table in counted.values() for t in table})
    # lower case before the lines are cut, so that the many conditions below read a finished column
    lines = files.select(*keys, F.explode(F.split(F.lower("text"), "\n")).alias("line")).where("line != ''")
    # one pass counts the lines (under the empty term) and those with each term
    distinct = lines.select(F.array_distinct(terms(F.col("line"))).alias("held")).where(F.size("held") > 0)
    held = distinct.select(F.explode(F.concat(F.array(F.lit("")), "held")).alias("term"))
    lines_with = materialize(held.groupBy("term").agg(F.count("*").alias("n")), "license-terms")
    known = {r["term"]: r["n"] for r in lines_with.where(F.col("term").isin("", *vocabulary)).collect()}  # the templates' terms
    total = known.get("", 0)
    squares = {t: math.log((1 + total) / (1 + known.get(t, 0))) ** 2 for t in vocabulary}
    lengths = {name: math.sqrt(sum(n * n * squares[t] for t, n in table.items())) for name, table in counted.items()}
    counted = {name: table for name, table in counted.items() if lengths[name]}
    if not counted:
        return files.select(*keys, F.lit("").alias("license"), F.lit(0.0).alias("cosine")).limit(0)
    # no line's cosine is above the length of the template's part that the line holds
    reaches = F.lit(False)
    for name, table in counted.items():
        shares = [F.when(F.contains("line", F.lit(t)), n * n * squares[t] / lengths[name] ** 2).otherwise(0.0) for t, n in table.items()]
        reaches = reaches | (sum(shares[1:], shares[0]) >= least * least - 1e-6)
    near = lines.where(reaches).select(*keys, terms(F.col("line")).alias("all"), F.monotonically_increasing_id().alias("_line"))
    near = materialize(near.where(F.size("all") > 0), "license-lines")  # few lines are left
    counts = F.transform(
        F.array_distinct("all"), lambda t: F.struct(t.alias("term"), F.size(F.filter("all", lambda x: x == t)).cast("double").alias("tf"))
    )
    each = near.select("_line", *keys, F.explode(counts).alias("t")).select("_line", *keys, "t.term", "t.tf")
    # apart, so that the join can split a term that many lines hold
    used = materialize(lines_with.join(each.select("term").distinct(), "term"), "license-weights")
    weight = F.log((1.0 + total) / (1 + F.col("n")))
    norm = F.sqrt(F.sum(F.col("tf") * F.col("tf") * weight * weight))
    dots = []
    for nth, (name, table) in enumerate(counted.items()):
        parts = {t: float(n) * squares[t] / lengths[name] for t, n in table.items()}
        dots.append(F.sum(F.col("tf") * F.coalesce(_number(parts, F.col("term")), F.lit(0.0))).alias(f"_dot{nth}"))
    near = each.join(used, "term").groupBy("_line", *keys).agg(norm.alias("_norm"), *dots)
    cosines = [
        F.struct(F.round(F.col(f"_dot{nth}") / F.nullif("_norm", F.lit(0.0)), 6).alias("cosine"), F.lit(-nth).alias("nth"), F.lit(name).alias("license"))
        for nth, name in enumerate(counted)
    ]
    near = near.withColumn("best", F.array_max(F.array(*cosines)))
    hits = near.where(F.col("best.cosine") >= least).select(*keys, "best.cosine", "best.license")
    first = F.min(F.struct((-F.col("cosine")).alias("worse"), "license"))
    return hits.groupBy(*keys).agg(first.alias("b")).select(*keys, "b.license", (-F.col("b.worse")).alias("cosine"))


def directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def above(folder: Column) -> Column:
    """A directory and all those above it."""
    parts = F.split(folder, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def inherited(files: DataFrame, own: DataFrame) -> DataFrame:
    """``folder``, ``license``, ``cosine`` and ``from_path`` of every directory that has a license file in or above it.

    Directories are collapsed before their ancestors are joined, so a directory's files do not matter.
    """
    named = own.where(F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENSE_FILE))
    best = F.min(F.struct((-F.col("cosine")).alias("worse"), F.col("path").alias("from_path"), "license"))
    holding = named.groupBy(directory(F.col("path")).alias("up")).agg(best.alias("best"))
    folders = files.where("path is not null").select(directory(F.col("path")).alias("folder")).distinct()
    climbed = folders.select("folder", F.explode(above(F.col("folder"))).alias("up"))
    nearest = climbed.join(holding, "up").groupBy("folder").agg(F.max_by("best", F.length("up")).alias("best"))
    return nearest.select("folder", F.col("best.license").alias("license"), (-F.col("best.worse")).alias("cosine"), "best.from_path")


def licensed(files: DataFrame, key: str, templates: dict[str, str] = TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """``key``, ``path``, ``license``, ``cosine``, ``origin`` (own, inherited, none) and ``from_path`` of every file."""
    files = files.select(key, "path", "text")
    own = materialize(scan(files, [key, "path"], templates, least), "license-own")
    passed = materialize(inherited(files, own), "license-folders")
    mine = own.select(F.col(key).alias("_key"), F.col("path").alias("_path"), F.col("license").alias("_license"), F.col("cosine").alias("_cosine"))
    names = files.select(key, "path", directory(F.col("path")).alias("folder"))
    rows = names.join(mine, names[key].eqNullSafe(mine["_key"]) & names["path"].eqNullSafe(mine["_path"]), "left").join(passed, "folder", "left")
    is_own = F.col("_license").isNotNull()
    return rows.select(
        key, "path",
        F.when(is_own, F.col("_license")).otherwise(F.col("license")).alias("license"),
        F.when(is_own, F.col("_cosine")).otherwise(F.col("cosine")).alias("cosine"),
        F.when(is_own, "own").when(F.col("license").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(is_own, F.col("path")).otherwise(F.col("from_path")).alias("from_path"),
    )
