"""Businesses as they might be written, with the fields that a careful reader would fill in: input and expectation of the text queries.

Each customer key gets one of these cases; {n} stands for the key. A case is country,
name, address, then what the fields must hold: name, alias, core, legal class, script
(true if not Latin), address, house number, range, postcode, landmark, other numbers,
and the core's words that the address lacks.
"""

from __future__ import annotations

FIELDS = ("name", "name_alias", "name_core", "name_legal_class", "non_latin", "addr", "house_num", "house_range", "postcode", "addr_landmark", "num_tokens", "name_core_minus_addr")

CASES = (
    ("US", "Blue Harbor Bakery {n} LLC", "{n} Larkspur Road, Springfield, 62704", "blue harbor bakery {n} llc", "", "blue harbor bakery {n}", "llc", False, "{n} larkspur road springfield 62704", "{n}", "", "62704", "", "", "blue harbor bakery"),
    ("US", "The Old Mill & Sons Inc. d/b/a Mill{n} Traders", "Unit {n}-B, Quarry St, near Town Hall, Dover", "old mill and sons inc", "mill{n} traders", "old mill and sons", "inc", False, "unit {n} b quarry st dover", "{n}", "", "", "town hall", "", "old mill and sons"),
    ("US", "Pine{n} Ltd Co", "PO Desk, {n}-7777 High Walk, Salem", "pine{n} ltd co", "", "pine{n}", "limited", False, "po desk {n} 7777 high walk salem", "{n}", "{n}-7777", "", "", "7777", "pine{n}"),
    ("India", "M/s Lotus{n} Textiles Pvt Ltd", "Shop No. {n}, Garden Lane, opp Clock Tower, Jaipur, 302001", "lotus{n} textiles pvt ltd", "", "lotus{n} textiles", "private_limited", False, "shop no {n} garden lane jaipur 302001", "{n}", "", "302001", "clock tower", "", "lotus{n} textiles"),
    ("India", "Shri Ganga{n} Stores", "Plot #{n}/7a, Sector Road, Pune 411001, see www.example.org", "ganga{n} stores", "", "ganga{n} stores", "none", False, "plot {n} 7a sector road pune 411001 see", "{n}7a", "", "411001", "", "{n} 7", "ganga{n} stores"),
    ("India", "\u0930\u093e\u092e {n} \u092d\u0935\u0928", "{n} \u0917\u0932\u0940, \u0926\u093f\u0932\u094d\u0932\u0940", "ram {n} bhavan", "", "ram {n} bhavan", "none", True, "{n} gali dilli", "{n}", "", "", "", "", "ram bhavan"),
    ("France", "SARL Caf\u00e9 \u00c9toile {n}", "{n} bis R. des Lilas, 69003 Lyon Cedex", "cafe etoile {n}", "", "cafe etoile {n}", "sarl", False, "{n}bis rue des lilas 69003 lyon", "{n}bis", "", "69003", "", "", "cafe etoile {n}"),
    ("France", "Soci\u00e9t\u00e9 Boulon{n} et Cie", "N\u00b0 {n} Bd du Port, BP 4471, 13002 Marseille", "boulon{n} et cie", "", "boulon{n} et", "other", False, "{n} boulevard du port 13002 marseille", "{n}", "", "13002", "", "", "boulon{n} et"),
    ("France", "Atelier{n} SAS", "{n}-99999 Q. des Forges, T.S.A 30012, 33000 Bordeaux", "atelier{n} sas", "", "atelier{n}", "sas", False, "{n} 99999 quai des forges 33000 bordeaux", "{n}", "{n}-99999", "33000", "", "99999", "atelier{n}"),
    ("France", "Moulin{n} f.k.a. Vieux Moulin{n} SA", "ZA des Pr\u00e9s, 44000 Nantes, contact@moulin.example", "moulin{n}", "vieux moulin{n} sa", "moulin{n}", "none", False, "zone artisanale des pres 44000 nantes", "", "", "44000", "", "", "moulin{n}"),
    ("Germany", "M\u00fcller {n} GmbH", "Stra\u00dfe {n}, 10115 Berlin", "muller {n} gmbh", "", "muller {n}", "other", False, "strasse {n} 10115 berlin", "10115", "", "", "", "{n}", "muller"),
    ("Germany", "\u0414\u043e\u043c{n} \u0416\u0443\u043a", "none, n/a, {n}a \u041c\u0438\u0440", "dom{n} zhuk", "", "dom{n} zhuk", "none", True, "{n}a mir", "{n}a", "", "", "", "", "dom{n} zhuk"),
    ("Greece", "\u0393\u03b1\u03bb\u03b1\u03be\u03af\u03b1\u03c2 {n}", "", "galaxias {n}", "", "galaxias {n}", "none", True, "", "", "", "", "", "", "galaxias {n}"),
    ("US", "Inc", "12th Floor, Annex {n}", "inc", "", "inc", "none", False, "12th floor annex {n}", "", "", "", "", "12 {n}", "inc"),
)

#: Learned forms (country, kind, form, target), and cases that hold them: country, name, address, name core, legal class, address.
LEARNED = (
    ("India", "dictionary", "bhavan", "house"),
    ("India", "part", "gali", "old lane"),
    ("India", "rewrite", "mrg", "marg road"),
    ("Germany", "legal", "ohg", "other"),
    ("France", "rewrite", "lyn", "lyon"),
)
LEARNED_CASES = (
    ("India", "\u0930\u093e\u092e {n} \u092d\u0935\u0928", "\u0917\u0932\u0940, {n} mrg", "ram {n} house", "none", "old lane {n} marg road"),
    ("India", "Ram {n} Bhavan", "Gali near gate, Mrg", "ram {n} bhavan", "none", "gali marg road"),
    ("Germany", "Kern {n} OHG", "Mrg {n}", "kern {n}", "other", "mrg {n}"),
    ("France", "Kern {n} OHG", "{n} R. Neuve, Lyn", "kern {n} ohg", "none", "{n} rue neuve lyon"),
    ("US", "Kern {n} OHG", "Gali, Lyn", "kern {n} ohg", "none", "gali lyn"),
)

#: The plainer form of a record under all flags: country, name, address, then words of the name, of the address, of the landmark, postal code, house numbers, name core.
BASIC_CASES = (
    ("US", "Birch{n} Cafe LLC", "{n} Elm St, Apt 4, Reno, NV 89501-1234", "birch{n} cafe", "{n} elm street apartment 4 reno nv 89501 1234", "", "89501", "{n} 4", "birch{n} cafe"),
    ("India", "Delhi Sweets Pvt Ltd", "Stall {n}, Ring Rd, near Metro Gate, Delhi", "delhi sweets", "stall {n} ring road delhi", "metro gate", "", "{n}", "sweets"),
    ("France", "Chez Lyon SARL", "{n} ter R. de la Paix, 69001 Lyon Cedex", "lyon", "{n}ter rue paix 69001 lyon", "", "69001", "{n}", ""),
    ("France", "Le Port", "ZI du Port, N\u00b0 {n} Imp. Basse", "port", "zone industrielle port {n} impasse basse", "", "", "{n}", ""),
    ("Germany", "Kern {n} a GmbH", "St {n} b, Dr X", "kern {n} a", "st {n} b dr", "", "", "{n}", "kern a"),
)
