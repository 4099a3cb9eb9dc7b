"""Fixed values and defaults of the debate operators; every one is a parameter somewhere."""

# Words that mark a reaction of the house, and phrases that mark business.
REACTION_WORDS = (
    "applaudissements?", "applaudit", "applaudissent", "sourires?", "rires?", "murmures?", "exclamations?",
    "protestations?", "brouhaha", "interruptions?", "huées?", r"vives?\s+réactions?", "mouvements?",
    r"marques?\s+d['’ ](?:approbation|assentiment)", r"très\s+bien", "bravo", r"bien\s+dit", "ah", "oh", "oui", "non",
    r"c['’ ]est\s+vrai",
)
# Honorifics that a speaker's label may open with.
HONORIFICS = ("m", "mm", "mr", "mme", "mmes", "mlle", "monsieur", "madame")
SPEAKER_MARKS = ("M.", "Mme", "Mmes", "MM.", "Mlle", "Monsieur", "Madame")
# Labels of whoever chairs a sitting.
CHAIR_KEYS = ("president", "le president", "la presidente", "monsieur le president", "madame la presidente")
CHAIR_PREFIXES = (
    "m le president", "m m le president", "m la presidente", "mme la presidente", "mme le presidente",
    "monsieur le president", "madame la presidente", "le president", "la presidente",
)
CHAIR_EXCEPTIONS = ("commission", "groupe", "delegation", "rapporteur")
CHAIR_LABEL = "presidency"
# Months, Roman numerals of terms, and the terms' first and last days.
MONTHS = {
    "janvier": 1, "fevrier": 2, "février": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7,
    "aout": 8, "août": 8, "septembre": 9, "octobre": 10, "novembre": 11, "decembre": 12, "décembre": 12,
}
ROMAN_TERMS = {"X": 10, "XI": 11, "XII": 12, "XIII": 13, "XIV": 14, "XV": 15, "XVI": 16, "XVII": 17}
TERMS = (
    (11, "1997-06-12", "2002-06-18"), (12, "2002-06-19", "2007-06-19"), (13, "2007-06-20", "2012-06-19"),
    (14, "2012-06-20", "2017-06-20"), (15, "2017-06-21", "2022-06-21"), (16, "2022-06-22", "2024-06-09"),
    (17, "2024-07-01", None),
)
# Historical labels and the party acronym that stands for each.
SPEECH_PARTY_ALIASES = {"ps": "SOC", "rpr": "R-UMP", "pcf": "GDR", "rcv": "RRDP"}
# Kinds of mandate from the first that counts as a person's status, clubs that a second one displaces, and
# the archive's address of a deputy in a directory.
STATUS_KINDS = ("ASSEMBLEE", "SENAT", "GOUVERNEMENT", "MINISTERE", "PRESREP", "CONSTITU")
WEAK_CLUBS = ("non inscrit", "non-inscrit", "non inscrits")
DIRECTORY_PATH = "/sycomore/fiche"
UNKNOWN_PARTY = "P000"
WEAK_PARTY = "P010"
# Starts of a title that carries on the line before.
CONTINUATIONS = ("DE ", "DU ", "DES ", "D'", "À ", "A ")
FRAGMENT_STARTS = ("A ", "À ", "AU ", "AUX ", "D'", "DE ", "DU ", "DES ", "ENTRE ", "ET ", "OU ", "POUR ", "RELATIF ", "RELATIVE ", "RELATIFS ", "RELATIVES ", "SUR ")
OPEN_ENDS = ("A", "À", "AU", "AUX", "D", "DE", "DU", "DES", "ET", "OU", "POUR", "RELATIF", "RELATIVE", "SUR", "LA", "LE", "LES", "L'")
# Fixed values of official summaries: its head, what ends it, starts of business that is no topic, titles of tables and
# of a law's parts, words of tables, titles that open a new topic without a number, and words that may follow a number.
SUMMARY_HEAD = "SOMMAIRE"
SUMMARY_ENDS = ("COMPTE RENDU", "PRÉSIDENCE", "SÉANCE DU", "M. LE PRÉSIDENT", "LA SÉANCE EST OUVERTE")
PROCEDURAL_STARTS = (
    "M.", "MM.", "MME", "MME.", "MMES", "MMES.", "MADAME", "MONSIEUR", "AMENDEMENT", "AMENDEMENTS", "QUESTION DE",
    "REJET", "ADOPTION", "SCRUTIN", "RAPPEL AU RÈGLEMENT DE M.",
)
FALSE_TITLES = ("TITRE I", "TITRE IER", "TITRE I ER", "ORIENTATIONS ET OBJECTIFS", "FRACTION DE LA PART NETTE TAXABLE", "TRANCHE DE TARIF", "TRANCHES DE TARIF")
WHOLE_FALSE_TITLES = ("TARIF APPLICABLE",)
TABLE_WORDS = ("TARIF", "FRACTION", "PART NETTE", "TAXABLE", "N'EXCÉDANT", "N EXCÉDANT")
LAW_PARTS = ("ARTICLE", "TITRE", "CHAPITRE", "SECTION")
UNNUMBERED_MAJORS = ("QUESTIONS AU GOUVERNEMENT", "QUESTIONS ORALES SANS DÉBAT", "PACTE CIVIL DE SOLIDARITÉ", "LOI DE FINANCEMENT", "RAPPELS AU RÈGLEMENT", "ORDRE DU JOUR")
GLUED_STARTS = ("QUESTIONS", "ORDRE", "FAIT", "DÉPÔT", "RAPPEL", "RAPPELS", "PACTE", "LOI", "MODIFICATION", "COMMUNICATION")
# Words after which a last number is a year or an article and no page.
NUMBERED_THINGS = ("POUR", "EN", "DE", "DU", "DES", "ARTICLE", "RN")
# What a title was worded like before (detail of a debate), openings that announce a title, and glued words.
DEBATE_DETAILS = ("Explications de vote", "Discussion générale", "Suite de la discussion", "Discussion d'un", "Vote sur")
ANNOUNCEMENTS = ("Nous passons", "Nous en revenons", "Nous revenons", "On en revient")
GLUED_WORDS = {"MODIFICATIONDE": "MODIFICATION DE", "ORDONNANCERELATIVE": "ORDONNANCE RELATIVE"}
# Capitals that scans write without their accents.
ACCENTS = {"EPERNAY": "ÉPERNAY", "REGLEMENT": "RÈGLEMENT", "REFORME": "RÉFORME", "SECURITE": "SÉCURITÉ", "WARTSILA": "WÄRTSILÄ"}

#: White space of Unicode, the separators U+001C to U+001F included, as a Java class body.
SPACE = r"\s\x{1c}-\x{1f}\x{85}\p{Z}"
FUZZY_LEAST, LINK_LEAST = 0.92, 0.80
SEPARATOR = "\n\n"

FLAT_COLUMNS = (
    "source_files", "id", "date", "text_speech_brut", "text_speech_clean", "topic", "subtopic1", "subtopic2",
    "speaker", "link_speaker", "role", "gender", "speech_interjection", "quote", "numSeance",
)
