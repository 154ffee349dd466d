"""Example articles for fine-tuning, 21 rows over the five meta-categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewloom.contracts import ARTICLE_SECTIONS

# meta-category, subject, three good products with their usual complaint, the worst one
SUBJECTS = [
    (0, "mystery novels", [("Harbour Lights", "slow first chapters"), ("The Ninth Key", "an abrupt ending"), ("Paper Tide", "many characters")], ("Cold Script", "misprinted pages")),
    (0, "board games", [("Canal Towns", "long setup"), ("Star Ledger", "small cards"), ("Fox and Field", "few rounds")], ("Quick Fortune", "missing dice")),
    (0, "gift baskets", [("Orchard Box", "a high price"), ("Tea Chest", "plain wrapping"), ("Movie Night", "little variety")], ("Jolly Tin", "stale biscuits")),
    (0, "acoustic guitars", [("Cedar One", "stiff strings"), ("Lark 200", "a thin case"), ("Meadow Mini", "quiet bass")], ("Starter X", "a warped neck")),
    (1, "car chargers", [("VoltPair", "a bright light"), ("RoadCell", "a tight fit"), ("Twinport", "a short cable")], ("ZapMax", "overheating")),
    (1, "dash cameras", [("LaneView", "a fiddly menu"), ("NightPilot", "large files"), ("MirrorCam", "a dim screen")], ("EyeBox", "lost recordings")),
    (1, "laptop stands", [("Risewell", "visible scratches"), ("FoldDesk", "some wobble"), ("AirShelf", "extra weight")], ("SlimProp", "broken hinges")),
    (1, "washing machine parts", [("SealRight", "thin instructions"), ("PumpPro", "extra noise"), ("DrumBelt", "a strong smell")], ("FixAll", "wrong sizes")),
    (2, "cordless drills", [("TorqueLine", "a heavy battery"), ("Borewell 12", "a slow charger"), ("Handy 8", "low power")], ("DrillIt", "a failing chuck")),
    (2, "hot glue guns", [("Meltpoint", "some dripping"), ("CraftFlow", "slow heating"), ("TinyStick", "a hot nozzle")], ("GlueGo", "leaking glue")),
    (2, "tape measures", [("TrueSpan", "a stiff lock"), ("MagReel", "a bulky case"), ("Pocket 5", "small print")], ("EasyPull", "wrong marks")),
    (2, "sewing kits", [("Threadbox", "few needles"), ("StitchPal", "dull scissors"), ("Hemline", "mixed colours")], ("SewQuick", "weak thread")),
    (3, "hair dryers", [("Breezeline", "a loud fan"), ("IonSoft", "a short cord"), ("TravelGust", "low heat")], ("DryFast", "a burning smell")),
    (3, "sunscreens", [("Daycover 50", "a white film"), ("SportShade", "a greasy feel"), ("MildSun", "a small tube")], ("SunNow", "skin rashes")),
    (3, "electric toothbrushes", [("PulseClean", "costly heads"), ("GumCare", "a weak timer"), ("Mintwave", "a loud motor")], ("BrushBot", "a dead battery")),
    (3, "vitamin gummies", [("Sunny D", "a sticky jar"), ("Balance Daily", "a sweet taste"), ("Greenbite", "an odd texture")], ("VitaPop", "melted pieces")),
    (4, "electric kettles", [("Steamwell", "slow pouring"), ("GlassBoil", "limescale"), ("QuietCup", "a small volume")], ("BoilX", "a leaking base")),
    (4, "garden hoses", [("FlexStream", "a stiff start"), ("GreenCoil", "some kinks"), ("Lawnline", "light fittings")], ("StretchHose", "a burst seam")),
    (4, "air fryers", [("CrispPod", "a short timer"), ("FamilyFry", "a large footprint"), ("Golden 4", "a loud beep")], ("FryEasy", "peeling coating")),
    (4, "bed sheets", [("Softfold", "wrinkles"), ("CoolWeave", "a thin feel"), ("Linen Day", "a rough start")], ("SilkStyle", "torn seams")),
    (4, "bird feeders", [("Finch House", "fiddly filling"), ("SeedTower", "a loose lid"), ("WindowWing", "weak cups")], ("BirdJoy", "rusted wire")),
]


def write_up(subject: str, best: list[tuple[str, str]], worst: tuple[str, str]) -> str:
    """An article with every required section, from the facts of one subject."""
    title, intro, top, warning, verdict = ARTICLE_SECTIONS
    names = [name for name, _ in best]
    picks = [f"{i}. {name} Key Strengths: praised by most buyers. Complaint: {flaw}." for i, (name, flaw) in enumerate(best, 1)]
    return "\n".join(
        [
            f"{title} {names[0]}, {names[1]} or {names[2]}? Three {subject} side by side",
            f"{intro} We read what buyers of {subject} wrote and picked three to keep and one to skip.",
            top,
            *picks,
            warning,
            f"Product: {worst[0]}",
            f"Buyers keep reporting {worst[1]}.",
            verdict,
            f"Choose {names[0]} first, {names[1]} for less money, {names[2]} for small needs. Leave {worst[0]} on the shelf.",
        ]
    )


def example_rows() -> list[tuple[int, str]]:
    return [(meta, write_up(subject, best, worst)) for meta, subject, best, worst in SUBJECTS]


def training_examples(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``meta_category, output`` rows, from a JSON-lines file or the built-in set."""
    schema = "meta_category int, output string"
    if path:
        return spark.read.schema(schema).json(path)
    return spark.createDataFrame(example_rows(), schema)
