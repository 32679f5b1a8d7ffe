"""Plain-Python model of the record rules, for tests only.

Written from the survey's description, independent of the Spark code:
``model(doc) -> (record dict or None, sorted list of (loc, kind))``.
"""

from __future__ import annotations

import re

NUM_RE = re.compile(r"[0-9]+(\.[0-9]+)?")
GRADE_RE = re.compile(r"^[0-9]+(\.[0-9]+)?-[0-9]+(\.[0-9]+)?-[0-9]+(\.[0-9]+)?\n?$")
REG_RE = re.compile(r"^[0-9]{7}[A-Z]\n?$")
MIN_RE = re.compile(r"\bminim\w*\b", re.IGNORECASE)
TYPES = ("ingredient_component", "fertilizer_product")
ABSENT = object()
# phone strings the generator draws from, with their E.164 text
PHONES = {"+1 800 640 9605": "+18006409605", "(757) 321-4567": "+17573214567",
          "123-456-7890": None, "1-800-GOT-JUNK": "+18004685865", "invalid phone": None,
          "+44 20 7946 0958": "+442079460958"}


def number(v):
    if isinstance(v, bool):
        return None
    if isinstance(v, (int, float)):
        return float(v)
    if isinstance(v, str):
        m = NUM_RE.search(v)
        return float(m.group()) if m else None
    return None


class Model:
    def __init__(self):
        self.issues = []

    def bad(self, loc, kind):
        self.issues.append((loc, kind))

    def string(self, v, loc, nonnull=False, required=False):
        if v is ABSENT:
            if required:
                self.bad(loc, "missing")
            return None
        if v is None:
            if nonnull:
                self.bad(loc, "string_type")
            return None
        if not isinstance(v, str):
            self.bad(loc, "string_type")
            return None
        return v

    def model_obj(self, v, loc, nullable, build):
        if v is ABSENT or v is None:
            if not nullable:
                self.bad(loc, "model_type")
            return None
        if not isinstance(v, dict):
            self.bad(loc, "model_type")
            return None
        return build(v, loc)

    def value(self, o, loc):
        if "value" not in o:
            self.bad(loc + ".value", "missing")
        if "unit" not in o:
            self.bad(loc + ".unit", "missing")
        return {"value": number(o.get("value")), "unit": self.string(o.get("unit", ABSENT), loc + ".unit")}

    def nutrient(self, o, loc):
        return {"nutrient": self.string(o.get("nutrient", ABSENT), loc + ".nutrient", nonnull=True,
                                        required=True),
                "value": number(o.get("value")),
                "unit": self.string(o.get("unit", ABSENT), loc + ".unit")}

    def registration(self, o, loc):
        ident = self.string(o.get("identifier", ABSENT), loc + ".identifier", required=True)
        t = o.get("type")
        return {"identifier": ident if ident is not None and REG_RE.match(ident) else None,
                "type": t if isinstance(t, str) and t in TYPES else None}

    def organization(self, o, loc):
        name = self.string(o.get("name", ABSENT), loc + ".name")
        addr = self.string(o.get("address", ABSENT), loc + ".address")
        web = self.string(o.get("website", ABSENT), loc + ".website")
        ph = self.string(o.get("phone_number", ABSENT), loc + ".phone_number")
        if web is not None:
            web = (web if web.startswith("www.") else "www." + web).lower()
        return {"name": name, "address": addr, "website": web,
                "phone_number": PHONES[ph] if ph is not None else None}

    def lst(self, v, loc, elem, absent_null=False):
        if v is ABSENT:
            return None if absent_null else []
        if v is None:
            return []
        if not isinstance(v, list):
            self.bad(loc, "list_type")
            return None
        return [elem(e, f"{loc}[{i}]") for i, e in enumerate(v)]

    def analysis(self, o, loc):
        title = self.string(o.get("title", ABSENT), loc + ".title")
        nut = o.get("nutrients", ABSENT)
        nutrients = self.lst(nut, loc + ".nutrients",
                             lambda e, l: self.model_obj(e, l, False, self.nutrient)) or []
        m = o.get("is_minimal", ABSENT)
        incoming = m if isinstance(m, bool) else None
        if isinstance(m, str):
            incoming = {**dict.fromkeys(("1", "on", "t", "true", "y", "yes"), True),
                        **dict.fromkeys(("0", "off", "f", "false", "n", "no"), False)}.get(m.lower())
        elif isinstance(m, (int, float)) and m in (0, 1):
            incoming = bool(m)
        if m is not ABSENT and m is not None and incoming is None:
            self.bad(loc + ".is_minimal", "bool_type")
        flag = bool(MIN_RE.search(title)) if title else incoming
        return {"title": title, "nutrients": nutrients, "is_minimal": flag}


def model(doc):
    m = Model()
    if not isinstance(doc, dict):
        return None, [("", "model_type")]
    g = lambda k: doc.get(k, ABSENT)
    models = lambda build: (lambda e, l: m.model_obj(e, l, False, build))
    strings = lambda e, l: m.string(e, l, nonnull=True)
    npk = m.string(g("npk"), "npk")
    rec = {
        "organizations": m.lst(g("organizations"), "organizations", models(m.organization)),
        "fertiliser_name": m.string(g("fertiliser_name"), "fertiliser_name"),
        "registration_number": m.lst(g("registration_number"), "registration_number",
                                     models(m.registration)),
        "lot_number": m.string(g("lot_number"), "lot_number"),
        "weight": m.lst(g("weight"), "weight", models(m.value)),
        "density": m.model_obj(g("density"), "density", True, m.value),
        "volume": m.model_obj(g("volume"), "volume", True, m.value),
        "npk": npk if npk is not None and GRADE_RE.match(npk) else None,
        "guaranteed_analysis_en": m.model_obj(g("guaranteed_analysis_en"), "guaranteed_analysis_en",
                                              True, m.analysis),
        "cautions_en": m.lst(g("cautions_en"), "cautions_en", strings, absent_null=True),
        "instructions_en": m.lst(g("instructions_en"), "instructions_en", strings),
        "ingredients_en": m.lst(g("ingredients_en"), "ingredients_en", models(m.nutrient)),
    }
    issues = sorted(m.issues)
    return (None if issues else rec), issues
