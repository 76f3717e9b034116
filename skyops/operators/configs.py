"""Inheritance, deep merge, diff, schema rules and drift over configuration node tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.functions.text import path_join, path_parent
from skyops.session import cut_and_count, cut_lineage

# Environment variables that are safe to record start with one of these.
SAFE_ENV_PREFIXES = ("PATH", "HOME", "USER", "SHELL", "LANG", "LC_", "TERM", "EDITOR")


# -- inheritance -------------------------------------------------------------------------

def ancestors(envs: DataFrame, parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chains (env, ancestor, depth), depth 0 being the environment itself, and the errors.

    Chains are doubled: those of length d that are still open are followed by the chains of their
    ends, so a depth of n takes log n joins. Every round is written to the shared folder, and a retry
    starts from the files. A parent that is already in the chain, or that does not exist, ends the
    chain as an error row.
    """
    known = envs.select(F.col("env").alias("_known")).distinct()
    missing = F.when(F.col("_known").isNull(), F.concat(F.lit("Config file not found: "), "parent"))
    first = parents.join(known, parents.parent == F.col("_known"), "left").select(
        "env", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"), F.array("env", "parent").alias("_seen"), missing.alias("_missing"))
    first = _ended(first)
    start = envs.select("env", F.col("env").alias("ancestor"), F.lit(0).alias("depth"), F.array("env").alias("_seen"),
                        F.lit(None).cast("string").alias("error"))
    rows, length = cut_lineage(start.unionByName(first)), 1
    while True:
        ends = rows.filter((F.col("depth") == length) & F.col("error").isNull()).select(
            "env", F.col("ancestor").alias("_end"), F.col("_seen").alias("_so_far"))
        on = rows.filter(F.col("depth") > 0).select(
            F.col("env").alias("_from"), "ancestor", (F.col("depth") + length).alias("depth"), F.col("_seen").alias("_then"),
            F.when(F.col("error").startswith("Config"), F.col("error")).alias("_missing"))
        longer = ends.join(on, F.col("_end") == F.col("_from")).select(
            "env", "ancestor", "depth", F.concat("_so_far", F.slice("_then", F.lit(2), F.size("_then"))).alias("_seen"), "_missing")
        step, n = cut_and_count(_ended(longer))
        if n == 0:
            break
        rows, length = rows.unionByName(step), 2 * length
    errors = rows.filter(F.col("error").isNotNull()).select("env", "error")
    chains = rows.filter(F.col("error").isNull()).select("env", "ancestor", "depth")
    return chains.join(errors.select("env"), "env", "left_anti"), errors


def _ended(chains: DataFrame) -> DataFrame:
    """Chains with the error that ends them; those that go on after a repeated environment are left out."""
    before = F.slice("_seen", F.lit(1), F.size("_seen") - 1)
    again = F.array_contains(before, F.col("ancestor"))
    circle = F.when(again, F.concat(F.lit("Circular inheritance detected: "), F.array_join("_seen", " → ")))
    return chains.filter(F.size(F.array_distinct(before)) == F.size(before)).select(
        "env", "ancestor", "depth", "_seen", F.coalesce("_missing", circle).alias("error"))


# -- deep merge --------------------------------------------------------------------------

def stack_levels(chains: DataFrame, nodes: DataFrame) -> DataFrame:
    """All nodes of all ancestors of an environment, with their depth (0 wins)."""
    n = nodes.select(F.col("env").alias("ancestor"), "path", "kind", "value")
    return chains.join(n, "ancestor").select("env", "depth", "path", "kind", "value")


def deep_merge(levels: DataFrame, keys: Sequence[str] = ("env",)) -> DataFrame:
    """Fold the levels of each tree: the nearest node of a path wins, dicts merge, and any other
    node wipes what deeper levels hold below it.

    A node therefore survives when it is the nearest of its path and no nearer level has a
    non-dict node at a proper prefix. Prefixes are exploded so that the test is an equi join.
    """
    at = [*keys, "path"]
    nearest = levels.groupBy(*at).agg(
        F.min_by(F.struct("depth", "kind", "value"), "depth").alias("_n"),
        F.min(F.when(F.col("kind") != "dict", F.col("depth"))).alias("_blocks"))
    rows = cut_lineage(nearest.select(*at, "_n.*", "_blocks"))  # read three times
    walls = rows.filter(F.col("_blocks").isNotNull()).select(
        *keys, F.col("path").alias("_wall"), "_blocks")
    below = rows.filter(F.size("path") > 1).select(
        *at, "depth",
        F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("path") - 1, F.lit(1))),
                              lambda i: F.slice("path", F.lit(1), i))).alias("_wall"))
    wiped = (below.join(walls, [*keys, "_wall"])
             .filter(F.col("_blocks") < F.col("depth")).select(*at).distinct())
    return rows.select(*at, "kind", "value").join(wiped, at, "left_anti")


def resolve(nodes: DataFrame, parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Resolved trees of all environments, and the inheritance errors."""
    nodes, parents = cut_lineage(nodes), cut_lineage(parents)
    envs = nodes.select("env").unionByName(parents.select("env")).distinct()
    chains, errors = ancestors(envs, parents)
    return deep_merge(stack_levels(chains, nodes)), errors


# -- diff --------------------------------------------------------------------------------

def canonical(kind: Column, value: Column) -> Column:
    """Text that is equal exactly for equal scalars: 1, 1.0 and true are one value.

    Integers are compared digit by digit, whatever their length; only numbers with a fraction or
    an exponent go through a double.
    """
    whole = F.regexp_replace(F.regexp_replace(value, "^(-?)0+(?=[0-9])", "$1"), "^-0$", "0")
    double = F.when(~value.startswith('"'), value.try_cast("double"))
    number = (F.when(value == "true", "1").when(value == "false", "0")
              .when(value.rlike("^-?[0-9]+$"), whole)
              .when((double % 1 == 0) & (F.abs(double) < 1e37), double.try_cast("decimal(38,0)").cast("string"))
              .otherwise(double.cast("string")))
    return F.when(kind == "scalar", F.coalesce(number, value)).otherwise(value)


def diff(left: DataFrame, right: DataFrame, keys: Sequence[str] = (),
         subtrees: bool = True) -> DataFrame:
    """(keys, path, operation, old_value, new_value) of two tree sets paired by ``keys``.

    A missing subtree is one entry at its highest node; dict against dict goes deeper. A node is
    reached only if its parent is a dict on both sides. Dict values are shown as a JSON object of
    their leaves under dotted names; without ``subtrees`` they stay null, which suits trees whose
    single subtrees are too large for a cell.
    """
    keys = list(keys)
    at = [*keys, "path"]

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.filter(F.size("path") > 0).select(
            *at, F.col("kind").alias(f"{tag}_kind"), F.col("value").alias(f"{tag}_value"))

    both = side(left, "l").join(side(right, "r"), at, "full_outer")
    shared = both.filter((F.col("l_kind") == "dict") & (F.col("r_kind") == "dict")).select(
        *keys, F.col("path").alias("_parent"))
    dicts = (F.col("l_kind") == "dict") & (F.col("r_kind") == "dict")
    equal = ((F.col("l_kind") == F.col("r_kind"))
             & canonical(F.col("l_kind"), F.col("l_value")).eqNullSafe(
                 canonical(F.col("r_kind"), F.col("r_value"))))
    changed = both.filter(F.col("l_kind").isNull() | F.col("r_kind").isNull()
                          | (~dicts & ~equal))
    top = changed.filter(F.size("path") == 1)
    inner = changed.filter(F.size("path") > 1).withColumn("_parent", path_parent(F.col("path")))
    reached = inner.join(shared, [*keys, "_parent"], "left_semi").drop("_parent")
    entries = top.unionByName(reached).withColumn(
        "operation", F.when(F.col("l_kind").isNull(), "added")
        .when(F.col("r_kind").isNull(), "removed").otherwise("changed"))
    if subtrees:
        entries = _with_subtree(entries, left, keys, "l")
        entries = _with_subtree(entries, right, keys, "r")
    return entries.select(*at, "operation", F.col("l_value").alias("old_value"),
                          F.col("r_value").alias("new_value"))


def _with_subtree(entries: DataFrame, tree: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """Fill the value of dict entries from the leaves below them."""
    at = [*keys, "path"]
    wanted = entries.filter(F.col(f"{tag}_kind") == "dict").select(*at)
    leaves = tree.filter((F.col("kind") != "dict") & (F.size("path") > 1))
    under = leaves.select(
        *keys, F.col("path").alias("_leaf"), "value",
        F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("path") - 1, F.lit(1))),
                              lambda i: F.slice("path", F.lit(1), i))).alias("path"))
    pair = F.concat(F.lit('"'),
                    path_join(F.slice("_leaf", F.size("path") + 1, F.size("_leaf"))),
                    F.lit('": '), "value")
    shown = under.join(wanted, at).groupBy(*at).agg(
        F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(pair)), ", "), F.lit("}"))
        .alias("_shown"))
    value = F.when(F.col(f"{tag}_kind") == "dict", F.coalesce("_shown", F.lit("{}"))).otherwise(
        F.col(f"{tag}_value"))
    return entries.join(shown, at, "left").withColumn(f"{tag}_value", value).drop("_shown")


def key_sets(left: DataFrame, right: DataFrame, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The key sets behind a diff: union, only left, only right, common."""
    l, r = left.select(*keys, "path"), right.select(*keys, "path")
    return {"union": l.union(r).distinct(), "left_only": l.subtract(r),
            "right_only": r.subtract(l), "common": l.intersect(r)}


# -- schema rules --------------------------------------------------------------------------

_CHECKED = ("type", "enum", "minLength", "pattern", "minimum", "maximum")
_RULES = "path array<string>, any_key boolean, keyword string, arg string"


def schema_rules(spark: SparkSession, schema: dict) -> DataFrame:
    """A draft-07 schema document as rule rows. ``any_key`` rules hold for every child of
    ``path`` that has no property of its own; ``items`` rules for every element of a list."""
    rows = []

    def visit(path, node, any_key=False):
        for keyword in _CHECKED:
            if keyword in node:
                rows.append((path, any_key, keyword, json.dumps(node[keyword])))
        for name in node.get("required", ()):
            rows.append((path, False, "required", json.dumps(name)))
        if isinstance(node.get("items"), dict) and "type" in node["items"]:
            rows.append((path, any_key, "items", json.dumps(node["items"]["type"])))
        for name, child in node.get("properties", {}).items():
            rows.append(([*path, name], False, "declared", "true"))
            visit([*path, name], child)
        if isinstance(node.get("additionalProperties"), dict):
            visit(path, node["additionalProperties"], True)

    visit([], schema)
    return spark.createDataFrame(rows, _RULES)


def json_type(kind: Column, value: Column) -> Column:
    number = F.when(~value.startswith('"'), value.try_cast("double"))
    return (
        F.when(kind == "dict", "object").when(kind == "list", "array").when(kind == "null", "null")
        .when(value.startswith('"'), "string").when(value.isin("true", "false"), "boolean")
        .when(number == F.floor(number), "integer").otherwise("number"))


def plain_text(value: Column) -> Column:
    """The string inside a JSON string literal."""
    return F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")


def shown_value(value: Column) -> Column:
    """A scalar the way messages spell it: 'text', True, None, 5."""
    return (
        F.when(value.startswith('"'), F.concat(F.lit("'"), plain_text(value), F.lit("'")))
        .when(value == "true", "True").when(value == "false", "False")
        .when(value.isNull(), "{...}").when(value == "null", "None").otherwise(value))


def violations(trees: DataFrame, rules: DataFrame, keys: Sequence[str] = ("env",)) -> DataFrame:
    """All rule violations of all trees: (keys, path, keyword, message)."""
    at = [*keys, "path"]
    nodes = trees.withColumns({"_type": json_type(F.col("kind"), F.col("value")),
                               "_shown": shown_value(F.col("value"))})
    own = rules.filter(~F.col("any_key") & ~F.col("keyword").isin("required", "declared"))
    exact = nodes.join(own.select("path", "keyword", "arg"), "path")

    declared = rules.filter(F.col("keyword") == "declared").select("path")
    wild = rules.filter("any_key").select(F.col("path").alias("_parent"), "keyword", "arg")
    children = (nodes.filter(F.size("path") > 0)
                .withColumn("_parent", path_parent(F.col("path")))
                .join(wild, "_parent").drop("_parent").join(declared, "path", "left_anti"))
    ruled = exact.unionByName(children.select(*exact.columns))

    found = ruled.withColumn("message", _message()).filter(F.col("message").isNotNull())
    out = found.select(*at, "keyword", "message")
    return out.unionByName(_bad_items(ruled, keys)).unionByName(_missing(trees, rules, keys))


def _message() -> Column:
    kind, value, arg = F.col("_type"), F.col("value"), F.col("arg")
    shown, keyword = F.col("_shown"), F.col("keyword")
    text = plain_text(value)
    number = F.when(kind.isin("integer", "number"), value.try_cast("double"))
    limit = arg.try_cast("double")
    wanted = plain_text(arg)
    fits = (kind == wanted) | ((wanted == "number") & (kind == "integer"))
    options = F.from_json(arg, "array<string>")
    listed = F.concat(F.lit("["), F.array_join(
        F.transform(options, lambda o: F.concat(F.lit("'"), o, F.lit("'"))), ", "), F.lit("]"))
    return (
        F.when((keyword == "type") & ~fits,
               F.concat(shown, F.lit(" is not of type '"), wanted, F.lit("'")))
        .when((keyword == "enum") & ~F.coalesce(F.array_contains(options, text), F.lit(False)),
              F.concat(shown, F.lit(" is not one of "), listed))
        .when((keyword == "minLength") & (kind == "string") & (F.length(text) < limit),
              F.concat(shown, F.lit(" is too short")))
        .when((keyword == "pattern") & (kind == "string") & ~F.rlike(text, wanted),
              F.concat(shown, F.lit(" does not match '"), wanted, F.lit("'")))
        .when((keyword == "minimum") & (number < limit),
              F.concat(shown, F.lit(" is less than the minimum of "), arg))
        .when((keyword == "maximum") & (number > limit),
              F.concat(shown, F.lit(" is greater than the maximum of "), arg)))


def _bad_items(ruled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """List elements of the wrong type; their path ends in the element's index."""
    items = F.from_json("value", "array<variant>")
    rows = (ruled.filter((F.col("keyword") == "items") & (F.col("kind") == "list"))
            .select(*keys, "path", "arg", F.posexplode(items).alias("_i", "_v")))
    text = F.to_json("_v")
    kind = F.when(text.startswith("{"), "dict").when(text.startswith("["), "list").when(
        text == "null", "null").otherwise("scalar")
    found, wanted = json_type(kind, text), plain_text(F.col("arg"))
    bad = (found != wanted) & ~((wanted == "number") & (found == "integer"))
    return rows.filter(bad).select(
        *keys, F.array_append("path", F.col("_i").cast("string")).alias("path"),
        F.lit("type").alias("keyword"),
        F.concat(shown_value(text), F.lit(" is not of type '"), wanted, F.lit("'")).alias("message"))


def _missing(trees: DataFrame, rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Required names absent from a dict that exists."""
    need = rules.filter(F.col("keyword") == "required").select(
        "path", plain_text(F.col("arg")).alias("_name"))
    holders = (trees.filter(F.col("kind") == "dict").join(need, "path")
               .withColumn("_child", F.array_append("path", F.col("_name"))))
    present = trees.select(*keys, F.col("path").alias("_child"))
    gone = holders.join(present, [*keys, "_child"], "left_anti")
    return gone.select(*keys, "path", F.lit("required").alias("keyword"),
                       F.concat(F.lit("'"), "_name", F.lit("' is a required property"))
                       .alias("message"))


def with_roots(nodes: DataFrame, keys: Sequence[str] = ("env",)) -> DataFrame:
    """Add the root node of every tree that lacks one."""
    roots = nodes.select(*keys).distinct().select(
        *keys, F.array().cast("array<string>").alias("path"), F.lit("dict").alias("kind"),
        F.lit(None).cast("string").alias("value"))
    return nodes.filter(F.size("path") > 0).select(*keys, "path", "kind", "value").unionByName(roots)


# -- software inventory -------------------------------------------------------------------------

def inventory(trees: DataFrame) -> DataFrame:
    """(env, package, version, source) declared below ``software``."""
    p = F.col("path")
    rows = trees.filter((F.size("path") == 3) & (p[0] == "software")
                        & p[1].isin("packages", "system_packages"))
    return rows.select(
        "env", p[2].alias("package"), F.coalesce(plain_text(F.col("value")), "value")
        .alias("version"), F.when(p[1] == "packages", "pip").otherwise("system").alias("source"))


def version_matrix(inv: DataFrame) -> DataFrame:
    """(package, env, version): a system package overrides a pip package of the same name."""
    rank = F.when(F.col("source") == "system", 1).otherwise(0)
    return inv.groupBy("package", "env").agg(F.max_by("version", rank).alias("version"))


def wide_matrix(matrix: DataFrame, envs: Sequence[str], absent: str = "-") -> DataFrame:
    """One column per named environment."""
    wide = matrix.groupBy("package").pivot("env", list(envs)).agg(F.first("version"))
    return wide.fillna(absent, subset=list(envs))


def drift(matrix: DataFrame, envs: DataFrame) -> DataFrame:
    """Packages with several versions, or absent from some environment of ``envs``."""
    n = envs.select("env").distinct().agg(F.count(F.lit(1)).alias("n"))
    return (
        matrix.groupBy("package")
        .agg(F.count_distinct("version").alias("versions"), F.count_distinct("env").alias("envs"))
        .filter((F.col("versions") > 1) | (F.col("envs") < n.scalar()))
    )


def missing_envs(matrix: DataFrame, envs: DataFrame) -> DataFrame:
    """(package, env) for every environment that lacks a package.

    A package that all environments have is counted out first. The pairs of the others are the
    result and what its packages do have; they are dealt by package and environment, not collected.
    """
    n = envs.select("env").distinct().agg(F.count(F.lit(1)).alias("n"))
    have = matrix.select("package", "env").distinct()
    some = have.groupBy("package").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < n.scalar()).select("package")
    deal = F.pmod(F.xxhash64("env"), F.lit(_DEALS))
    every = some.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(_DEALS - 1)))).join(
        envs.select("env").distinct().withColumn("_deal", deal.cast("int")), "_deal").select("package", "env")
    return every.join(have, ["package", "env"], "left_anti")


#: Into how many parts the environments are dealt.
_DEALS = 16


def inventory_rows(matrix: DataFrame, envs: DataFrame, trees: DataFrame | None = None, absent: str = "-") -> DataFrame:
    """(package, env, version, drift) for every package and environment; with ``trees`` also OS and Python as packages.

    The report in rows, for any number of environments; ``wide_matrix`` makes columns of a named few.
    """
    flags = drift(matrix, envs).select("package", F.lit(True).alias("drift"))
    rows = matrix.select("package", "env", "version").unionByName(
        missing_envs(matrix, envs).withColumn("version", F.lit(absent)))
    out = rows.join(flags, "package", "left").withColumn("drift", F.coalesce("drift", F.lit(False)))
    if trees is None:
        return out
    runtime = runtime_versions(trees).select("env", F.inline(F.array(
        F.struct(F.lit("os").alias("package"), F.col("os").alias("version")),
        F.struct(F.lit("python").alias("package"), F.col("python").alias("version")))))
    return out.withColumn("section", F.lit("packages")).unionByName(
        runtime.withColumns({"drift": F.lit(False), "section": F.lit("runtime")}))


def inventory_report(matrix: DataFrame, envs: DataFrame, names: Sequence[str]) -> DataFrame:
    """The wide matrix with a drift flag."""
    flags = drift(matrix, envs).select("package", F.lit(True).alias("drift"))
    return wide_matrix(matrix, names).join(flags, "package", "left").withColumn(
        "drift", F.coalesce("drift", F.lit(False)))


def runtime_versions(trees: DataFrame) -> DataFrame:
    """OS and Python version per environment that names at least one; ``?`` for the other."""
    p, v = F.col("path"), plain_text(F.col("value"))
    wide = trees.filter((F.size("path") == 2) & (p[0] == "software")).groupBy("env").agg(
        F.max(F.when(p[1] == "os_version", v)).alias("os"),
        F.max(F.when(p[1] == "python_version", v)).alias("python"))
    known = (F.coalesce("os", F.lit("")) != "") | (F.coalesce("python", F.lit("")) != "")
    show = {c: F.when(F.coalesce(c, F.lit("")) == "", "?").otherwise(F.col(c))
            for c in ("os", "python")}
    return wide.filter(known).withColumns(show)


def safe_env(env_vars: Column, prefixes: Sequence[str] = SAFE_ENV_PREFIXES) -> Column:
    """Entries of a map whose key starts with an allowed prefix."""
    def allowed(k, _v):
        test = F.lit(False)
        for p in prefixes:
            test = test | k.startswith(p)
        return test

    return F.map_filter(env_vars, allowed)
