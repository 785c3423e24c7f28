"""Vocabularies of the catalog as plain relations: patterns of file classes, the class graph, credit roles with their validity, codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: How a class is told from a file's name. Class, pattern on the lower-case name, literals of which one must occur, containers, pattern that denies.
CLASS_PATTERNS = [
    ("operations_manual", r"operation(s)? manual|operating manual", ["operation", "operating"], None, None),
    ("service_manual", r"service manual|repair manual|shop manual|maintenance manual", ["service manual", "repair manual", "shop manual", "maintenance manual"], None, None),
    ("owners_manual", r"owner.?s? manual", ["owner"], None, None),
    ("installation_instructions", r"installation instruction", ["installation instruction"], None, None),
    ("manual", r"\bmanual\b", ["manual"], None, None),
    ("handbook", r"handbook", ["handbook"], None, None),
    ("schematic", r"schematic", ["schematic"], None, None),
    ("wiring_diagram", r"wiring|cabinet diagram|harness", ["wiring", "cabinet diagram", "harness"], None, None),
    ("engineering_drawing", r"engineering drawing|assembly drawing|drawing package", ["engineering drawing", "assembly drawing", "drawing package"], None, None),
    ("engineering_drawing", r"factory drawing|pictorial diagram|assembly diagram", ["factory drawing", "pictorial diagram", "assembly diagram"], None, None),
    ("cad_file", r"\bcad\b|fusion 360|\bdxf\b|overlay template", ["cad", "fusion 360", "dxf", "overlay template"], None, None),
    ("bill_of_material", r"bill of material|\bbom\b", ["bill of material", "bom"], None, None),
    ("specification", r"specification|datasheet|theory of operation|test procedure", ["specification", "datasheet", "theory of operation", "test procedure"], None, None),
    ("parts_list", r"parts (list|catalog|diagram|layout)|part list|parts identification", ["part"], None, None),
    ("switch_matrix", r"switch matrix|switch(es)?[ ,/].*(matrix|chart|list|data)", ["switch"], None, None),
    ("switch_matrix", r"lamps?/solenoid|solenoid matrix", ["solenoid"], None, None),
    ("coil_chart", r"coil (chart|list|renumbering)|solenoid (list|table|identification)", ["coil ", "solenoid "], None, None),
    ("dip_switch", r"dip switch", ["dip switch"], None, None),
    ("score_motor_chart", r"score motor|cam (switch|map|identification)|relay chart|motor switch", ["score motor", "cam ", "relay chart", "motor switch"], None, None),
    ("rubber_ring_chart", r"rubber ring", ["rubber ring"], None, None),
    ("adjustments", r"adjustment", ["adjustment"], None, None),
    ("service_bulletin", r"bulletin", ["bulletin"], None, None),
    ("notice_to_operators", r"notice to operators|message to operators|customer service notice|shipping notice", ["notice to operators", "message to operators", "customer service notice", "shipping notice"], None, None),
    ("flyer", r"flyer", ["flyer"], None, None),
    ("brochure", r"brochure|promotional folder", ["brochure", "promotional folder"], None, None),
    ("advertisement", r"advertisement|\badvert", ["advert"], None, None),
    ("feature_matrix", r"game features (comparison|matrix|presentation)|comparison chart by model", ["game features ", "comparison chart by model"], None, None),
    ("feature_matrix", r"features? (list|explanation)", ["feature"], None, None),
    ("press_release", r"press release|website announcement", ["press release", "website announcement"], None, None),
    ("price_card", r"price card|pricing card|plays per quarter|replay card|replays card", ["price card", "pricing card", "plays per quarter", "replay card", "replays card"], None, None),
    ("promotional_photo", r"promotional photo|promo photo|promotional postcard", ["promo"], None, None),
    ("instruction_card", r"instruction card|score card|game card", ["instruction card", "score card", "game card"], None, None),
    ("warranty", r"warrant", ["warrant"], None, None),
    ("packing_list", r"packing list|check off list|shipping paperwork|inspection slip", ["packing list", "check off list", "shipping paperwork", "inspection slip"], None, None),
    ("certificate", r"certificate", ["certificate"], None, None),
    ("rules_of_play", r"rules of play|game rules|how.to.play|rules flowchart|game operation", ["rules of play", "game rules", "how", "rules flowchart", "game operation"], None, None),
    ("strategy_guide", r"strategy|tip sheet|quick tips|quick take|\bguide\b|rule ?sheet", ["strategy", "tip sheet", "quick tips", "quick take", "guide", "rulesheet", "rule sheet"], None, None),
    ("game_description", r"game (description|history)|description of game|narrative|proposed game theme", ["game ", "description of game", "narrative", "proposed game theme"], None, None),
    ("interview", r"interview|discusses|discussing|\bq&a\b|letter from|open letter", ["interview", "discuss", "q&a", "letter"], None, None),
    ("credits", r"personnel credits|autograph|contributors", ["personnel credits", "autograph", "contributors"], None, None),
    ("correspondence", r"inter-office|communication to|\bmemo\b", ["inter-office", "communication to", "memo"], None, None),
    ("artwork_scan", r"artwork|plastic scans|plastics|decal|apron art|spinner graphics|insert graphic", ["artwork", "plastic", "decal", "apron art", "spinner graphics", "insert graphic"], None, None),
    ("photo_set", r"factory photos|additional (external|internal) pictures|image portfolio|images of", ["factory photos", "additional ", "image portfolio", "images of"], None, None),
    ("game_audio", r"\btune\b|music|sound|audio", ["tune", "music", "sound", "audio"], ["mp3", "wav", "zip"], r"\brom|prom\b|speech chip|chip u[0-9]"),
    ("video", r"movie|video", ["movie", "video"], ["mpg", "mp4", "mov", "avi", "wmv", "zip"], None),
    ("rom_set", r"\brom(s|set)?\b|eprom|\bprom\b|speech chip|gamerom", ["rom", "speech chip"], ["zip", "bin", "716", "732", "764", "hex"], None),
    ("accessory_kit", r"accessories|retrofit|\bkit\b", ["accessories", "retrofit", "kit"], None, None),
    ("supplement", r"addendum|errata|supplement", ["addendum", "errata", "supplement"], None, None),
    ("patent", r"\bpatent", ["patent"], ["pdf"], None),
    ("trade_article", r"article|journal|magazine|coin slot|automatic age", ["article", "journal", "magazine", "coin slot", "automatic age"], ["pdf", "txt"], None),
    ("trade_article", r"der automat|spinning reels|newpaper|newspaper|monitor, vol|souvenir guide", ["der automat", "spinning reels", "newpaper", "newspaper", "monitor, vol", "souvenir guide"], ["pdf", "txt"], None),
]

#: Child class and parent class.
CLASS_PARENTS = [
    ("operations_manual", "manual"), ("service_manual", "manual"), ("owners_manual", "manual"), ("wiring_diagram", "schematic"),
    ("switch_matrix", "service_reference"), ("coil_chart", "service_reference"), ("dip_switch", "service_reference"),
    ("score_motor_chart", "service_reference"), ("rubber_ring_chart", "service_reference"), ("adjustments", "service_reference"),
    ("flyer", "marketing"), ("brochure", "marketing"), ("advertisement", "marketing"), ("feature_matrix", "marketing"),
    ("press_release", "marketing"), ("price_card", "marketing"), ("promotional_photo", "marketing"),
]

#: Classes whose files are addressed otherwise than by document.
SOURCE_KINDS = {"patent": "patent", "trade_article": "trade_article"}

#: Credit role, slug, the dump's field (None: only archived pages may supply the role), and the labels of archived pages.
CREDIT_ROLES = [
    ("Design", "design", "DesignBy", ["Design by"]),
    ("Art", "art", "ArtBy", ["Art by"]),
    ("Dots/Animation", "animation", "DotsAnimationBy", ["Dots/Animation by", "Animation by"]),
    ("Mechanics", "mechanics", "MechanicsBy", ["Mechanics by"]),
    ("Music", "music", "MusicBy", ["Music by"]),
    ("Sound", "sound", "SoundBy", ["Sound by"]),
    ("Software", "software", "SoftwareBy", ["Software by"]),
    ("Concept", "concept", None, ["Concept by"]),
]

#: Technology codes and display kinds with their slugs.
TECHNOLOGY = [("em", "electromechanical"), ("ss", "solid-state"), ("me", "pure-mechanical")]
DISPLAYS = [("reels", "score-reels"), ("lights", "backglass-lights"), ("alphanumeric", "alphanumeric"), ("cga", "cga"), ("dmd", "dot-matrix"), ("lcd", "lcd")]


def classes() -> list[tuple[str, str]]:
    """Every class with its source kind: those that patterns may emit, and parents that only group."""
    named = dict.fromkeys([p[0] for p in CLASS_PATTERNS] + [p for _, p in CLASS_PARENTS])
    return [(c, SOURCE_KINDS.get(c, "document")) for c in named]


def relation(spark: SparkSession, name: str) -> DataFrame:
    """One vocabulary as a typed relation; list-valued columns stay lists."""
    rows, schema = {
        "class_patterns": (CLASS_PATTERNS, "document_class string, pattern string, required_any array<string>, allow_containers array<string>, deny_pattern string"),
        "class_parents": (CLASS_PARENTS, "child string, parent string"),
        "classes": (classes(), "document_class string, source_kind string"),
        "credit_roles": (CREDIT_ROLES, "role string, role_slug string, field string, labels array<string>"),
        "technology": (TECHNOLOGY, "code string, slug string"),
        "displays": (DISPLAYS, "code string, slug string"),
    }[name]
    return spark.createDataFrame(rows, schema)
