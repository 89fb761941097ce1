import pytest

from grapheon.notation import model
from grapheon.notation.lexer import NotationError, tokens
from grapheon.notation.statements import parse

TEXT = """
// a line comment
package Plant {
    import Units::**;
    abstract part def Pump { doc /* Moves
          * water. */ attribute mass = 4.5 [SI::kg]; attribute low = -5 [kg]; port inlet : ~Fluid; }
    port def Fluid;
    part def Boost :> Pump { :>> mass = 6 [kg]; @Rationale { text = "spare"; } }
    part <'P-1'> main : Boost [1..*] { attribute sum = mass + low * 2; attribute same = mass; perform action run; }
    part other : Pump[*];
    part def Tank { attribute mass; }
    connection link connect main.inlet to other.inlet;
    bind main.mass = other.mass;
    requirement def <R1> Flow { subject s : Pump; require constraint { s.mass > 3 } }
    satisfy Flow by main;
    #refinement dependency main to other;
    variation part choice : Pump { variant part a; variant part b; }
    alias Mover for Pump;
    part moved : Mover;
    flow of Fluid from main.inlet to other.inlet;
    allocate main to other;
    part known : Elsewhere::Thing;
    action def Cycle { first start; then action fill; then action drain { in x; } succession first fill then stop; action stop; }
    state def Modes { entry; then off; state off; state on; transition up first off accept Go if main.mass > 1 then on; item def Go; }
}
"""


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [("plant/a.sysml", TEXT), ("plant/units.sysml", "package Units { part def Volt; }"), ("bad/x.sysml", "part 'open"), ("none/y.sysml", None), ("empty/z.sysml", "")]
    return model.declarations(spark.createDataFrame(rows, "path string, text string")).cache()


def test_tokens():
    assert [t.text for t in tokens("a::b :>> 1..* 2.5e3 'x y' // gone\n/* k */")] == ["a", "::", "b", ":>>", "1", "..", "*", "2.5e3", "x y", "k"]
    with pytest.raises(NotationError):
        tokens('"open')
    with pytest.raises(NotationError):
        parse("part a {")
    assert parse("") == []


def test_elements(parsed):
    rows = {r["qualified"]: r for r in model.elements(parsed).collect()}
    pump, main = rows["Plant::Pump"], rows["Plant::main"]
    assert pump["is_definition"] and pump["doc"] == "Moves\nwater." and pump["modifiers"] == ["abstract"] and pump["owner"] == "plant::Plant"
    assert (main["short_name"], main["multiplicity"]["lower"], main["multiplicity"]["upper"]) == ("P-1", 1, None)
    assert rows["Plant::other"]["multiplicity"].asDict() == {"text": "*", "lower": 0, "upper": None}
    mass, low = rows["Plant::Pump::mass"]["value"], rows["Plant::Pump::low"]["value"]
    assert (mass["num"], mass["unit"]) == (4.5, "kg") and low["num"] is None and low["operator"] == "unary -"
    assert rows["Plant::main::sum"]["value"]["operator"] == "+" and rows["Plant::main::same"]["value"]["reference"] == "mass"
    assert rows["Plant::Boost"]["rationale"] == "spare" and pump["key"].startswith("plant_Plant_Pump_")
    assert rows["Plant::Pump::inlet"]["conjugated"] and rows["Plant::Boost::mass"]["anonymous"]


def test_relations(parsed):
    related = model.relations(parsed).cache()
    got = {(r["src"].removeprefix("plant::Plant::"), r["label"], r["dst"].removeprefix("plant::Plant::")) for r in model.edges(related).collect()}
    want = {
        ("Boost", "specializes", "Pump"), ("main", "typedBy", "Boost"), ("Boost::mass", "redefines", "Pump::mass"), ("Pump::inlet", "conjugates", "Fluid"), ("main::same", "bindsTo", "Boost::mass"),
        ("main", "performs", "main::run"), ("link", "connects", "Pump::inlet"), ("main", "satisfies", "Flow"), ("main", "dependsOn", "other"),
        ("choice::a", "variantOf", "choice"), ("moved", "typedBy", "Mover"), ("Mover", "aliasOf", "Pump"), ("main", "allocates", "other"), ("Flow", "subject", "Flow::s"),
        ("Cycle::fill", "transitionsTo", "Cycle::drain"), ("Cycle::fill", "transitionsTo", "Cycle::stop"), ("Modes::off", "transitionsTo", "Modes::on"), ("Modes::up", "triggeredBy", "Modes::Go"),
        ("Boost::mass", "bindsTo", "Pump::mass"), ("plant::Plant", "imports", "plant::Units"), ("Modes::up", "guardedBy", "Boost::mass"),
    }
    assert want - got == set()
    missed = {(r["label"], r["written"]): r["external"] for r in model.unresolved(related).collect()}
    assert missed[("typedBy", "Elsewhere::Thing")] is True
    assert related.filter("src = dst").count() == 0


def test_errors_and_attributes(parsed):
    assert [(r["path"], r["line"]) for r in parsed.filter("kind = 'error'").collect()] == [("bad/x.sysml", 1)]
    found = {r["owner"]: r["attributes"] for r in model.attributes(model.elements(parsed)).collect()}
    assert found["plant::Plant::Pump"]["mass"]["num"] == 4.5 and set(found["plant::Plant::main"]) == {"sum", "same"}
