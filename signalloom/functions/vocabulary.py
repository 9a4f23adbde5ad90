"""Default parameter tables: word lists, label maps, stages. All operators take them as arguments."""

from __future__ import annotations

# Domain labels in the order in which they are tried, with their terms.
DOMAINS: dict[str, list[str]] = {
    "GEO_GEOLOGY": ["earthquake", "seismic", "volcano", "volcanic", "eruption", "tsunami", "landslide", "geology", "tectonic", "fault line", "magnitude", "usgs"],
    "ENVIRONMENTAL": [
        "hurricane", "tropical storm", "flood", "wildfire", "drought", "deforestation", "climate change", "emissions", "pollution", "epa", "noaa", "water quality",
        "coral reef", "sea level", "carbon", "biodiversity", "species", "ecosystem", "prasa", "acueducto", "aqueduct", "wastewater", "alcantarillado", "sewer",
        "reservoir", "embalse", "represa", "boil water", "boil-water", "hervir el agua", "racionamiento", "sequia", "luma", "prepa", "preb", "outage", "apagon", "aee",
    ],
    "ANOMALOUS": [
        "ufo", "uap", "unidentified", "anomalous aerial", "paranormal", "extraterrestrial", "alien", "crop circle", "orb sighting", "seti", "unexplained phenomenon",
        "abduction", "cryptid", "bigfoot", "ghost", "poltergeist", "interdimensional",
    ],
    "MILITARY_AEROSPACE": [
        "military", "defense", "pentagon", "nato", "air force", "navy", "army", "missile", "drone strike", "fighter jet", "aircraft carrier", "satellite launch",
        "space force", "rocket", "aerospace", "lockheed", "boeing defense", "raytheon", "northrop", "general dynamics", "hypersonic", "stealth", "warplane", "combat",
        "aviation", "faa", "airspace", "flight test",
    ],
    "FINANCIAL": [
        "stock market", "interest rate", "federal reserve", "inflation", "gdp", "recession", "cryptocurrency", "bitcoin", "sec", "ipo", "merger", "acquisition",
        "earnings", "hedge fund", "bond yield", "treasury", "imf", "world bank", "trade deficit", "tariff", "sanctions", "contract", "contrato", "contractor",
        "contratista", "award", "awarded", "adjudicacion", "aviso de adjudicacion", "subasta", "licitacion", "procurement", "rfp", "joint venture", "obra publica",
        "obras publicas", "construccion", "infraestructura",
    ],
    "POLITICAL": [
        "election", "congress", "senate", "legislation", "bill passed", "executive order", "president", "prime minister", "parliament", "geopolitics", "diplomacy",
        "sanctions", "war", "conflict", "protest", "coup", "treaty", "summit", "government", "policy", "regulation",
    ],
    "SAFETY_COMPLIANCE": [
        "osha", "occupational safety", "occupational health", "workplace safety", "worker safety", "workplace fatality", "worker death", "safety violation",
        "willful violation", "serious violation", "safety citation", "workplace hazard", "imminent danger", "amputation", "severe injury report", "workplace injury",
        "seguridad ocupacional", "seguridad laboral", "salud ocupacional", "muerte de trabajador", "accidente laboral",
    ],
}
UNCLASSIFIED = "UNCLASSIFIED"

# Finer tags of water and utility items, in order.
WATER_TAGS: dict[str, list[str]] = {
    "potable_water": ["prasa", "acueducto", "aqueduct", "agua potable", "drinking water", "water utility", "water main", "water service"],
    "boil_water": ["boil water", "boil-water", "hervir el agua", "boil advisory", "boil-water advisory"],
    "water_quality": ["water quality", "contamination", "contaminacion", "turbidity", "sdwis", "e. coli", "coliform"],
    "wastewater": ["wastewater", "alcantarillado", "sewer", "sewage", "aguas usadas", "aguas negras", "npdes"],
    "reservoir_drought": ["reservoir", "embalse", "represa", "drought", "sequia", "racionamiento", "water rationing", "dam safety"],
    "flood": ["flood", "inundacion", "flash flood", "flooding"],
    "power_grid": ["luma", "prepa", "preb", "power outage", "apagon", "blackout", "grid", "aee", "generation"],
}

# Terms of emergencies.
URGENT = [
    "emergency", "emergencia", "evacuate", "evacuation", "evacuacion", "evacuar", "boil water", "hervir el agua", "tsunami", "hurricane warning", "aviso de huracan",
    "flash flood", "inundacion repentina", "mandatory", "obligatorio", "shelter in place", "refugio", "curfew", "toque de queda", "immediate", "inmediato", "urgent",
    "urgente", "life-threatening", "peligro de muerte", "explosion", "explosión", "wildfire", "landslide", "derrumbe", "toxic", "toxico", "contamination emergency",
    "workplace fatality", "worker death", "muerte de trabajador", "imminent danger", "peligro inminente", "amputation", "fatal injury", "workplace explosion",
]

# Agencies and what they are called.
AGENCIES: dict[str, list[str]] = {
    "Puerto Rico National Guard": ["national guard", "guardia nacional"],
    "USACE": ["usace", "army corps of engineers", "cuerpo de ingenieros"],
    "FEMA": ["fema"],
    "PRASA": ["prasa", "acueductos y alcantarillados"],
    "PREPA": ["prepa", "autoridad de energia electrica"],
    "COR3": ["cor3", "central office for recovery"],
    "Autoridad de Carreteras y Transportacion": ["autoridad de carreteras", "carreteras y transportacion"],
    "Department of Transportation": ["department of transportation", "departamento de transportacion", "dtop"],
}

# Procurement terms.
AWARD = ["awarded", "award of", "adjudicacion", "adjudico", "adjudicada", "aviso de adjudicacion", "won the contract", "wins contract"]
SOLICITATION = ["rfp", "request for proposal", "request for proposals", "subasta", "licitacion", "solicitation", "bid opening"]
PROCUREMENT = [*AWARD, *SOLICITATION, "contract", "contrato", "procurement", "obra publica", "obras publicas"]

# Scale words of amounts.
SCALES = {"mil millones": 1e9, "billions": 1e9, "billion": 1e9, "millones": 1e6, "millions": 1e6, "million": 1e6, "millon": 1e6}

#: Label -> target; the names of targets are parameters. The hub gets every item that passes the gate.
TARGETS = {
    "ENVIRONMENTAL": "water", "FINANCIAL": "finance", "POLITICAL": "finance", "GEO_GEOLOGY": "terrain", "ANOMALOUS": "anomaly", "MILITARY_AEROSPACE": "aerospace", "SAFETY_COMPLIANCE": "water",
}
HUB, FINANCE_TARGETS, WATER_TARGETS = "hub", ("finance",), ("water", "hub")

# Confidences of the tiers, and the least that is routed.
SEVERAL_LABELS, ONE_LABEL, NO_LABEL, MODEL_DEFAULT, GATE = 0.85, 0.6, 0.3, 0.5, 0.55

# Stages of a matter and their order; an unknown stage counts as the second.
STAGES = {"raw_observation": 0, "public_signal": 1, "developing_matter": 2, "pending_officialization": 3, "officialized": 4, "execution_amendment": 5, "audit_dispute_impact": 6}
DEFAULT_STAGE, OFFICIAL = 1, 4

# What makes a matter ready to be handed over.
TRIGGERS = [
    "law_number_assigned", "contract_awarded", "signed_contract_published", "payment_issued", "permit_number_issued", "court_case_number_assigned", "audit_report_published",
    "grant_obligation_published", "appointment_confirmed", "executive_order_published",
]

# Phrases that claim what isn't official yet.
OFFICIAL_CLAIMS = [
    "aprobado definitivamente", "contrato adjudicado", "ley vigente", "fondos desembolsados", "permiso emitido", "caso radicado", "auditoría final", "officially approved",
    "contract awarded", "funds disbursed", "permit issued", "case filed",
]

# Least score of each band, with its name.
BANDS = [(95, "T1 confirmado"), (85, "Oficial preliminar"), (70, "Corroborado"), (50, "Monitor"), (30, "Débil"), (None, "No publicar como hecho")]

# Matter type -> type of official record.
RECORD_TYPES = {"law": "law_record", "permit": "permit_record", "court_case": "court_record", "audit": "audit_record", "grant": "grant_award", "appointment": "official_appointment"}
DEFAULT_RECORD_TYPE = "contract_record"

EVIDENCE_TIERS = ("T1", "T2", "T3", "T4")
DISPATCH_STATES = ("ok", "failed", "skipped")
