"""A text with the notation's forms, read as each region's model; what it must give was worked out by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grapheon.notation import model as notation
from grapheon.registry import _read

#: A query and the SQL of its rows, by name.
CASES = {}


def query(sql, _prelude):
    def add(f):
        CASES[f.__name__] = f, sql
        return f

    return add

VOCABULARY = """package Plant {
    private import Units::*;
    abstract part def Pump { attribute mass = 4.5 [kg]; port inlet : ~Fluid; }
    port def Fluid;
    part def Boost :> Pump { attribute :>> mass default = 6 [kg]; }
    part <'P-1'> main : Boost [1..*] { attribute sum = mass or low xor high; perform action run; exhibit state on; }
    part other : Pump[*] references main;
    connection link connect main to other;
    bind main = other;
    requirement def Flow { subject s : Pump; actor who : Pump; require constraint enough { s.mass > 3 } }
    requirement need : Flow;
    satisfy need by main;
    verify need by other;
    dependency main to other;
    variation part choice : Pump { variant part a; variant part b; }
    alias Mover for Pump;
    flow of Fluid from main to other;
    allocate main to other;
    action def Cycle { first start; then action fill; then action drain; decide; if full then drain; else fill; }
    state def Modes { state off; state onn; transition up first off accept Go if main.mass > 1 then onn; item def Go; }
    part PUMP : Pump;
    calc def Sum { in x; x + 2 * (x - 1) }
}
"""
FAULTY = {"comment": "part a;\n  /* open", "quote": "part\n'a", "string": 'attribute a = "b', "body": "part a {\n  part b;", "bracket": "part a [1"}


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "region").select(F.concat(F.lit("m"), F.col("r_regionkey").cast("string"), F.lit("/model.sysml")).alias("path"), F.lit(VOCABULARY).alias("text"))


def _values(columns: str, rows: list[tuple]) -> str:
    """SQL for these rows in the module of each region."""
    shown = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)
    return f"SELECT 'm' || r_regionkey AS module, v.* FROM region CROSS JOIN (VALUES {', '.join('(' + ', '.join(map(shown, r)) + ')' for r in rows)}) v({columns})"


LABELS = [
    ("actor", 1), ("aliasOf", 1), ("allocates", 1), ("bindsTo", 1), ("carries", 1), ("conjugates", 1), ("connectedTo", 1), ("connects", 2), ("dependsOn", 1), ("exhibits", 1), ("flows", 1), ("guardedBy", 1),
    ("owns", 39), ("performs", 1), ("redefines", 1), ("referencesFeature", 1), ("requires", 1), ("satisfies", 1), ("specializes", 1), ("startsAt", 1), ("subject", 1), ("transitionsTo", 4),
    ("triggeredBy", 1), ("typedBy", 7), ("variantOf", 2), ("verifies", 1),
]


@query(_values("label, n", LABELS), False)
def notation_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of each label."""
    found = notation.edges(notation.relations(notation.declarations(sources(spark, sf_dir))))
    return found.groupBy("module", "label").agg(F.count(F.lit(1)).alias("n"))


BRANCHES = [("Plant::Cycle::if@19", "Plant::Cycle::drain", "then"), ("Plant::Cycle::if@19", "Plant::Cycle::fill", "else")]


@query(_values("src, dst, branch", BRANCHES), False)
def notation_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arms of a condition."""
    found = notation.edges(notation.relations(notation.declarations(sources(spark, sf_dir)))).filter("label = 'transitionsTo' and detail['branch'] is not null")
    plain = lambda c: F.regexp_replace(c, "^m[0-9]+::", "")
    return found.select("module", plain("src").alias("src"), plain("dst").alias("dst"), F.col("detail")["branch"].alias("branch"))


WRITTEN = [("Plant::Cycle", "startsAt", "start", True), ("Plant::Cycle::if@19", "guardedBy", "full", True)]


@query(_values("src, label, written, external", WRITTEN), False)
def notation_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References that mean nothing here."""
    found = notation.unresolved(notation.relations(notation.declarations(sources(spark, sf_dir))))
    return found.select("module", F.regexp_replace("src", "^m[0-9]+::", "").alias("src"), "label", "written", "external")


DISPLAYS = [
    ("Plant::Pump", 3, "PLANT_PUMP_DEF"), ("Plant::Boost", 5, "BOOST"), ("Plant::main", 6, "MAIN"), ("Plant::other", 7, "OTHER"), ("Plant::need", 11, "PLANT_NEED_L11"), ("Plant::need", 12, "PLANT_NEED_L12"),
    ("Plant::need", 13, "PLANT_NEED_L13"), ("Plant::Flow", 10, "FLOW"), ("Plant::choice", 15, "CHOICE"), ("Plant::choice::a", 15, "A"), ("Plant::choice::b", 15, "B"), ("Plant::PUMP", 21, "PLANT_PUMP"),
]


@query(_values("qualified, line, display", DISPLAYS), False)
def notation_displays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that are unique in a model: of a definition and a usage, of one name declared three times, and of others."""
    found = notation.elements(notation.declarations(sources(spark, sf_dir)))
    return found.filter("kind in ('part', 'requirement')").select("module", "qualified", "line", "display")


TREES = [
    ("Plant::main::sum", '["or", ["reference", "mass"], ["xor", ["reference", "low"], ["reference", "high"]]]'),
    ("Plant::Flow::enough", '[">", ["reference", "s.mass"], ["number", 3.0]]'),
    ("Plant::Modes::up", '[">", ["reference", "main.mass"], ["number", 1.0]]'),
    ("Plant::Sum", '["+", ["reference", "x"], ["*", ["number", 2.0], ["-", ["reference", "x"], ["number", 1.0]]]]'),
]


@query(_values("qualified, tree", TREES), False)
def notation_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = notation.elements(notation.declarations(sources(spark, sf_dir)))
    return found.select("module", "qualified", F.coalesce("value.tree", "expression.tree").alias("tree")).filter("tree is not null")


SENTENCES = [
    ("Plant::Pump", "PLANT_PUMP_DEF is a abstract part definition declared in Plant::Pump, mass = 4.5 kg, at {module}/model.sysml:3."),
    ("Plant::Boost", "BOOST is a part definition declared in Plant::Boost, specializing Pump, mass = 6 kg, at {module}/model.sysml:5."),
    ("Plant::main", "MAIN is a part declared in Plant::main, typed by Boost, with multiplicity [1..*], sum = mass or low xor high, at {module}/model.sysml:6. Also written P-1."),
    ("Plant::other", "OTHER is a part declared in Plant::other, typed by Pump, with multiplicity [*], at {module}/model.sysml:7."),
    ("Plant::Boost::mass", "BOOST_MASS is a attribute declared in Plant::Boost::mass, redefining mass, whose value is 6 kg, at {module}/model.sysml:5."),
]


@query("SELECT module, qualified, replace(text, '{module}', module) AS description FROM (" + _values("qualified, text", SENTENCES) + ")", False)
def notation_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = notation.elements(notation.declarations(sources(spark, sf_dir)))
    said = notation.descriptions(found).join(found.select("module", "identity", "qualified"), ["module", "identity"])
    return said.filter(F.col("qualified").isin([q for q, _ in SENTENCES])).select("module", "qualified", "description")


FAULTS = [("comment", 2, 3, "a comment is not ended"), ("quote", 2, 1, 'unexpected "\'"'), ("string", 1, 15, "unexpected '\"'"), ("body", 2, 9, "a body or bracket is not ended"), ("bracket", 1, 9, "a body or bracket is not ended")]


@query(_values("fault, line, col, message", FAULTS), False)
def notation_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with an error give where it is, and stop nothing."""
    region = _read(spark, sf_dir, "region").select(F.concat(F.lit("m"), F.col("r_regionkey").cast("string")).alias("module"))
    files = region.select("module", F.explode(F.create_map(*(F.lit(x) for kv in FAULTY.items() for x in kv))).alias("fault", "text"))
    found = notation.declarations(files.select(F.concat("module", F.lit("/"), "fault").alias("path"), "text"))
    return found.filter("kind = 'error'").select("module", F.split("path", "/")[1].alias("fault"), "line", F.col("column").alias("col"), "message")
