"""Fixed values.

These must equal the published cleaning rules for the results to be right:
word lists, patterns, corrections and thresholds. They are data, stated here
as text and used nowhere else as literals.
"""

# A bare key of the relaxed object literal, and its quoted form.
BARE_KEY_PATTERN = "([A-zÀ-ÿ ]+):"
BARE_KEY_REPLACEMENT = '"$1":'

# Connectors written in lower case inside a title-cased name, in order.
CONNECTOR_RULES = [
    (" Do ", " do "),
    (" Da ", " da "),
    (" De ", " de "),
    ("D'oeste", "D'Oeste"),
]

# Growing edit distances of the matching stages and of the report.
MATCH_DISTANCES = (1, 2)
REPORT_DISTANCE = 5

# Hand-kept corrections (name in the data, official name), source 1.
CROSSWALK_SOURCE_1 = [
    ("Embu", "Embu das Artes"),
    ("Fortaleza do Tabocão", "Tabocão"),
    ("São Valério da Natividade", "São Valério"),
    ("Campo de Santana", "Tacima"),
    ("Olho-D'água do Borges", "Olho d'Água do Borges"),
    ("Augusto Severo", "Campo Grande"),
    ("Seridó", "São Vicente do Seridó"),
    ("Santarém", "Joca Claudino"),
]

# Hand-kept corrections, source 3 (upper-cased before use).
CROSSWALK_SOURCE_3 = [
    ("COUTO MAGALHÃES DE MINAS", "COUTO DE MAGALHÃES DE MINAS"),
    ("ITABIRINHA DE MANTENA", "ITABIRINHA"),
    ("SANTARÉM", "JOCA CLAUDINO"),
    ("SÃO DOMINGOS DE POMBAL", "SÃO DOMINGOS"),
    ("SERIDÓ", "São Vicente do Seridó"),
    ("Augusto Severo", "Campo Grande"),
    ("Embu", "Embu das Artes"),
    ("COUTO DE MAGALHÃES", "COUTO MAGALHÃES"),
    ("Fortaleza do Tabocão", "Tabocão"),
    ("São Valério da Natividade", "São Valério"),
]

# Records known to be wrong.
SOURCE_1_EXCLUSIONS = [{"Modulo_fiscal_ha": 0, "MUN_NAME": "Penha"}]
GAP_EXCLUSIONS = [{"MUN_CODE": 4314530}, {"MUN_NAME": "Piçarras"}]
