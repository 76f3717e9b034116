import random

import pytest
from pyspark.sql import functions as F

from skyops.functions.secrets import redact
from skyops.operators import configs, secrets
from skyops.sources import configs as source

yaml = pytest.importorskip("yaml")


def nodes(spark, **trees):
    df = spark.createDataFrame([(k, yaml.safe_dump(v)) for k, v in trees.items()],
                               "env string, value string")
    return source.nodes_of(df)


def flat(df):
    return {(".".join(r.path), r.operation, r.old_value, r.new_value) for r in df.collect()}


def diff(spark, left, right):
    a = nodes(spark, t=left).drop("env")
    b = nodes(spark, t=right).drop("env")
    return flat(configs.diff(a, b))


def test_nested_addition_is_one_entry(spark):
    assert diff(spark, {"a": {"b": {}}}, {"a": {"b": {"c": 1}}}) == {("a.b.c", "added", None, "1")}
    assert diff(spark, {}, {"a": {"b": {"c": 1}}}) == {("a", "added", None, '{"b.c": 1}')}


def test_dict_to_scalar_is_one_change(spark):
    assert diff(spark, {"a": {"b": 1}}, {"a": 5}) == {("a", "changed", '{"b": 1}', "5")}


def test_equal_values(spark):
    assert diff(spark, {"a": 1, "b": True, "c": [1]}, {"a": 1.0, "b": 1, "c": [1]}) == set()
    assert diff(spark, {"a": "1"}, {"a": 1}) == {("a", "changed", '"1"', "1")}


def random_tree(rng, depth=0):
    kind = rng.random()
    if depth < 3 and (depth == 0 or kind < 0.5):
        return {k: random_tree(rng, depth + 1) for k in rng.sample("abc", rng.randrange(4))}
    return rng.choice([None, 1, "x", [1, 2]])


def fold(base, over):
    out = dict(base)
    for k, v in over.items():
        out[k] = fold(out[k], v) if isinstance(out.get(k), dict) and isinstance(v, dict) else v
    return out


def test_deep_merge_against_fold(spark):
    rng = random.Random(5)
    sets = [[random_tree(rng) for _ in range(3)] for _ in range(150)]
    rows = [(str(i), d, yaml.safe_dump(t)) for i, s in enumerate(sets) for d, t in enumerate(s)]
    levels = source.nodes_of(spark.createDataFrame(rows, "env string, depth int, value string"))
    merged = configs.deep_merge(levels)
    want = nodes(spark, **{str(i): fold(fold(s[2], s[1]), s[0]) for i, s in enumerate(sets)})
    key = lambda df: sorted(map(str, df.select("env", "path", "kind", "value").collect()))
    assert key(merged) == key(want)


def test_diff_against_recursion(spark):
    rng = random.Random(6)
    pairs = [(random_tree(rng), random_tree(rng)) for _ in range(100)]

    def walk(a, b, path=()):
        for k in sorted(set(a) | set(b)):
            if k not in b:
                yield (*path, k), "removed"
            elif k not in a:
                yield (*path, k), "added"
            elif isinstance(a[k], dict) and isinstance(b[k], dict):
                yield from walk(a[k], b[k], (*path, k))
            elif a[k] != b[k]:
                yield (*path, k), "changed"

    want = {(str(i), p, op) for i, (a, b) in enumerate(pairs) for p, op in walk(a, b)}
    left = nodes(spark, **{str(i): a for i, (a, _) in enumerate(pairs)})
    right = nodes(spark, **{str(i): b for i, (_, b) in enumerate(pairs)})
    got = {(r.env, tuple(r.path), r.operation)
           for r in configs.diff(left, right, ["env"]).collect()}
    assert got == want


def test_inheritance_from_files(spark, tmp_path):
    for name, text in {
        "base": "app: {name: x, debug: false}\nlist: [1]\n",
        "dev": "inherits: base\napp: {debug: true}\n", "prod": "inherits: dev\nlist: [2]\n",
        "loop": "inherits: pool\n", "pool": "inherits: loop\n", "lost": "inherits: none\n",
        "empty": "",
    }.items():
        (tmp_path / f"{name}.yaml").write_text(text)
    parents, body = source.parents_of(source.read_config_nodes(spark, str(tmp_path)))
    trees, errors = configs.resolve(body, parents)
    got = {(r.env, ".".join(r.path)): r.value for r in trees.collect()}
    assert got["prod", "app.debug"] == "true" and got["prod", "app.name"] == '"x"'
    assert got["prod", "list"] == "[2]" and ("empty", "") in got
    bad = {r.env: r.error for r in errors.collect()}
    assert set(bad) == {"loop", "pool", "lost"}
    assert bad["lost"].endswith("none") and "Circular" in bad["loop"]


def test_schema_messages(spark):
    schema = {"type": "object", "required": ["app"], "properties": {
        "app": {"type": "object", "required": ["name"], "properties": {
            "version": {"type": "string", "pattern": r"^\d+\.\d+\.\d+$"},
            "port": {"type": "integer", "minimum": 1, "maximum": 65535},
            "level": {"type": "string", "enum": ["INFO", "DEBUG"]},
            "hosts": {"type": "array", "items": {"type": "string"}}}},
        "features": {"type": "object", "additionalProperties": {"type": "boolean"}}}}
    trees = nodes(spark, bad={"app": {"version": "1.0", "port": 70000, "level": "X",
                                      "hosts": ["a", 1]}, "features": {"f": "yes", "g": True}},
                  none={}, good={"app": {"name": "n", "port": 1, "version": "1.2.3"}})
    rules = configs.schema_rules(spark, schema)
    got = {(r.env, ".".join(r.path), r.message) for r in configs.violations(trees, rules).collect()}
    assert got == {
        ("bad", "app.version", "'1.0' does not match '^\\d+\\.\\d+\\.\\d+$'"),
        ("bad", "app.port", "70000 is greater than the maximum of 65535"),
        ("bad", "app.level", "'X' is not one of ['INFO', 'DEBUG']"),
        ("bad", "app.hosts.1", "1 is not of type 'string'"),
        ("bad", "app", "'name' is a required property"),
        ("bad", "features.f", "'yes' is not of type 'boolean'"),
        ("none", "", "'app' is a required property")}


def test_drift(spark):
    sw = lambda **p: {"software": {"packages": p, "os_version": "U"}}
    a, b = sw(x="1", y="2", z="3"), sw(x="1", y="9")
    a["software"]["system_packages"] = {"x": "1"}
    trees = nodes(spark, a=a, b=b)
    matrix = configs.version_matrix(configs.inventory(trees))
    envs = trees.select("env").distinct()
    assert {r.package for r in configs.drift(matrix, envs).collect()} == {"y", "z"}
    assert [tuple(r) for r in configs.missing_envs(matrix, envs).collect()] == [("z", "b")]
    rep = {r.package: (r.a, r.b, r.drift) for r in configs.inventory_report(
        matrix, envs, ["a", "b"]).collect()}
    assert rep["z"] == ("3", "-", True) and rep["x"] == ("1", "1", False)
    assert {(r.env, r.os, r.python) for r in configs.runtime_versions(trees).collect()} == {
        ("a", "U", "?"), ("b", "U", "?")}


def test_secret_scan(spark, tmp_path):
    (tmp_path / "bad.yaml").write_text("name: safe\npassword: secret123\nkey: AKIA" + "A" * 16 + "\n")
    (tmp_path / "ok.yaml").write_text("app:\n  name: safe\n")
    (tmp_path / "bin.dat").write_bytes(b"\x00password: secret123")
    got = {(r.line_number, r.pattern, r.shown) for r in secrets.scan_files(spark, str(tmp_path))
           .withColumn("shown", redact(F.col("matched"))).collect()}
    assert got == {(2, "password", "pass***t123"), (3, "aws_access_key", "AKIA***AAAA")}


def test_snapshots(spark, tmp_path):
    (tmp_path / "s1.yaml").write_text(
        "hostname: h\npackages:\n- {name: a, version: '1.0', source: apt}\n- {name: b, version: '2'}\n")
    (tmp_path / "s2.yaml").write_text("")
    got = {tuple(r) for r in source.read_snapshots(spark, str(tmp_path)).collect()}
    assert got == {("s1", "h", "a", "1.0", "apt"), ("s1", "h", "b", "2", "pip")}


def test_packed_snapshots(spark, tmp_path):
    """The same rows as from a file for each, empty and JSON documents included, from few files."""
    texts = {f"s{i}": f"hostname: h{i % 3}\npackages:\n- {{name: a, version: '{i}', source: apt}}\n- {{name: b, version: '2'}}\n"
             for i in range(50)} | {"empty": "", "json": '{"hostname": "j", "packages": [{"name": "c", "version": "3"}]}'}
    (tmp_path / "single").mkdir()
    for name, text in texts.items():
        (tmp_path / "single" / f"{name}.yaml").write_text(text)
    docs = spark.createDataFrame(list(texts.items()), "env string, value string").repartition(3)
    source.write_packs(docs, str(tmp_path / "packed"))
    got = sorted(map(tuple, source.read_snapshots(spark, str(tmp_path / "packed"), packed=True).collect()))
    assert got == sorted(map(tuple, source.read_snapshots(spark, str(tmp_path / "single")).collect())) and len(got) == 101
    assert len(list((tmp_path / "packed").glob("part-*"))) <= 3


def test_snapshots_of_many_suppliers_are_few_files(spark, tmp_path):
    from pathlib import Path

    import __spark_entry__
    from skyops.session import scratch_dir

    rows = [(i, i % 5) for i in range(1, 301)] + [(7, 2), (None, 1)]
    spark.createDataFrame(rows, "s_suppkey long, s_nationkey int").coalesce(1).write.parquet(str(tmp_path / "sf" / "supplier.parquet"))
    shared = Path(scratch_dir(spark, "x")).parent
    before = set(shared.rglob("part-*"))
    got = [tuple(r) for r in __spark_entry__.queries()["src_snapshots"](spark, str(tmp_path / "sf")).collect()]
    assert got.count(("S7", "host2", "pkg2", "7.1", "pip")) == 1 and ("S10", "host0", "base", "2.0", "pip") in got
    assert len({r[0] for r in got}) == 300 + any(r[0] is None for r in got) and len(got) in (600, 602)
    assert 0 < len(set(shared.rglob("part-*")) - before) < 20


def test_long_integers_are_compared_by_digits(spark):
    from pyspark.sql import functions as F

    from skyops.operators import configs

    pairs = [("9007199254740993", "9007199254740992", False), ("1", "1.0", True), ("true", "1", True), ("-0", "0", True),
             ("0.10", "0.1", True), ("100000000000000000000", "1e20", True), ('"1"', "1", False), ("007", "7", True)]
    df = spark.createDataFrame(pairs, "a string, b string, same boolean")
    got = df.select((configs.canonical(F.lit("scalar"), F.col("a")) == configs.canonical(F.lit("scalar"), F.col("b"))).alias("s"), "same")
    assert all(r.s == r.same for r in got.collect())
