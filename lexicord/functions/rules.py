"""Rule tables of the text functions, as data."""

from __future__ import annotations

# Latin letters that look like Greek ones, and those they stand for.
LOOKALIKES_LATIN = "ABEZHIKMNOPTXYovpx"
LOOKALIKES_GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΧΥονρχ"

# Single characters that are always replaced, and their replacements.
REPLACED = "∆∑Ω´’“”– "
REPLACEMENTS = "ΔΣΩ΄'\"\"- "
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl"}

# Lines of a gazette page that are no text (Java patterns for whole lines).
PAGE_NOISE = (
    r"(?iuU)^\s*ΕΦΗΜΕΡΙ[Δ∆]Α\s+[ΤT]ΗΣ\s+ΚΥΒΕΡΝΗΣΕΩΣ\s*$",
    r"(?iuU)^\s*ΕΦΗΜΕΡΙΣ\s+[ΤT]ΗΣ\s+ΚΥΒΕΡΝΗΣΕΩΣ\s*$",
    r"(?iuU)^\s*Τε[υύ]χος\s+[Α-Ω]΄?\s*\d+\s*/\s*[\d.\-/]+\s*$",
    r"(?iuU)^\s*ΕΘΝΙΚΟ\s+ΤΥΠΟΓΡΑΦΕΙΟ\s*$",
    r"(?U)^\s*\d{1,6}\s*$",
    r"(?U)^\s*[-—]\s*\d{1,6}\s*[-—]\s*$",
    r"(?U)^\s*$",
)

# What a legal database leaves in its exports.
DATABASE_TRACES = (
    r"(?U)Πληροφορίες\s+Νομολογίας\s*&\s*Αρθρογραφίας\s*:\s*\d+",
    r"(?U)Προισχύσασες\s+μορφές\s+άρθρου\s*:\s*\d+",
    r"(?U)Κατ['΄’]?\s*Εξουσιοδότηση\s+εκδοθείσα\s+Νομοθεσία\s*:\s*\d+",
)
# A database's marker of an article, and an article's own heading below it (before and after its number).
ARTICLE_MARKER = r"[ΆΑ]ρθρο\s*:\s*(\d+)"
OWN_HEADING = (r"^[ \t]*[ΆΑ]ρθρο[νΝ]?[ \t]+", r"[ \t]*[.:]?[ \t]*$")
#: How far below a database marker the article's own heading is looked for.
HEADING_REACH = 300

# Part and Chapter numerals.
ORDINALS = "ΠΡΩΤΟ|ΔΕΥΤΕΡΟ|ΤΡΙΤΟ|ΤΕΤΑΡΤΟ|ΠΕΜΠΤΟ|ΕΚΤΟ|ΕΒΔΟΜΟ|ΟΓΔΟΟ|ΕΝΑΤΟ|ΔΕΚΑΤΟ"
NUMERAL = rf"{ORDINALS}|[Α-Ω]{{1,4}}[΄']?"
# The words and forms of headings and numbered paragraphs, and how far a title goes on.
ARTICLE_WORD = "[ΆΑ]ρθρο[νΝ]?|[ΆΑ]ΡΘΡΟ[Ν]?"
#: A heading line of any kind; groups: Part, Chapter, article number, article letter.
HEADING = rf"(?Umd)^\s*(?:ΜΕΡΟΣ\s+({NUMERAL})|ΚΕΦΑΛΑΙΟ\s+({NUMERAL})|(?:{ARTICLE_WORD})\s+(\d+)\s*([Α-Ωα-ω])?\s*[.:]?)\s*$"
PARAGRAPH = r"(?Umd)^\s*(\d{1,3})\.(?:[ \t]+|(?=\D))"
TITLE_LINES = 6
TITLE_GOES_ON = r"[-,—–]$"

# Spoken names of letters.
LETTER_NAMES = {
    "α": "άλφα", "β": "βήτα", "γ": "γάμμα", "δ": "δέλτα", "ε": "έψιλον", "στ": "στίγμα", "ζ": "ζήτα", "η": "ήτα", "θ": "θήτα",
    "ι": "γιώτα", "κ": "κάππα", "λ": "λάμδα", "μ": "μι", "ν": "νι", "ξ": "ξι", "ο": "όμικρον", "π": "πι", "ρ": "ρο", "σ": "σίγμα",
    "τ": "ταυ", "υ": "ύψιλον", "φ": "φι", "χ": "χι", "ψ": "ψι", "ω": "ωμέγα",
}

# Abbreviations in the order in which they are spoken out, by what must follow.
ACTS = (
    (r"ν\.δ\.", "νομοθετικού διατάγματος"),
    (r"π\.δ\.", "προεδρικού διατάγματος"),
    (r"κ\.υ\.α\.?", "κοινής υπουργικής απόφασης"),
    (r"υ\.α\.", "υπουργικής απόφασης"),
    (r"ν\.", "νόμου"),
    (r"α\.ν\.", "αναγκαστικού νόμου"),
)
NUMBERED = (
    (r"παρ\.", "παράγραφος"),
    (r"περ\.", "περίπτωση"),
    (r"υποπερ\.", "υποπερίπτωση"),
    (r"εδ\.", "εδάφιο"),
    (r"άρθρ\.", "άρθρο"),
    (r"αρ\.", "αριθμός"),
    (r"σελ\.", "σελίδα"),
)
ALONE = (
    (r"κ\.λπ\.", "και λοιπά"),
    (r"κ\.ά\.", "και άλλα"),
    (r"κ\.ο\.κ\.", "και ούτω καθεξής"),
    (r"π\.χ\.", "για παράδειγμα"),
    (r"βλ\.", "βλέπε"),
    (r"χλμ/ώρα", "χιλιόμετρα την ώρα"),
    (r"χλμ/ω", "χιλιόμετρα την ώρα"),
    (r"χλμ\.?", "χιλιόμετρα"),
    (r"γρ\./λίτρο", "γραμμάρια ανά λίτρο"),
    (r"κ\.εκ\.", "κυβικά εκατοστά"),
    (r"gr\./l\b", "γραμμάρια ανά λίτρο"),
    (r"km/h\b", "χιλιόμετρα την ώρα"),
    (r"mg/l\b", "χιλιοστά του γραμμαρίου ανά λίτρο"),
    (r"τ\.μ\.", "τετραγωνικά μέτρα"),
)

# Months in the genitive, gazette series, act names.
MONTHS = ("Ιανουαρίου", "Φεβρουαρίου", "Μαρτίου", "Απριλίου", "Μαΐου", "Ιουνίου", "Ιουλίου", "Αυγούστου", "Σεπτεμβρίου", "Οκτωβρίου", "Νοεμβρίου", "Δεκεμβρίου")
SERIES_CODES = {"A": "01", "B": "02", "C": "03", "D": "04"}
SERIES_GREEK = {"A": "Α", "B": "Β", "C": "Γ", "D": "Δ"}
SERIES_SPOKEN = {"A": "Άλφα", "B": "Βήτα", "C": "Γάμμα", "D": "Δέλτα", "Α": "Άλφα", "Β": "Βήτα", "Γ": "Γάμμα", "Δ": "Δέλτα"}
ACT_SHORT = {"nomos": "Ν.", "pd": "Π.Δ.", "ya": "Υ.Α.", "kya": "Κ.Υ.Α.", "kanonismos_ee": "Καν.", "odigia_ee": "Οδηγία"}
ACT_SPOKEN = {
    "nomos": "Νόμος",
    "pd": "Προεδρικό διάταγμα",
    "ya": "Υπουργική απόφαση",
    "kya": "Κοινή υπουργική απόφαση",
    "kanonismos_ee": "Κανονισμός της Ευρωπαϊκής Ένωσης",
    "odigia_ee": "Οδηγία της Ευρωπαϊκής Ένωσης",
}
EU_ACTS = ("kanonismos_ee", "odigia_ee")
IN_FORCE = "isxyon"
STATUSES = ("isxyon", "katargimeno", "istoriko")
SUPPLEMENT = "sympliroma"

# Order of preference of sources; types that are not listed come after, in file order.
SOURCE_ORDER = ("fek_pdf", "topiko_fek", "kodikopoiimeno_html", "pdf_alli_pigi", "doc_alli_pigi")
SOURCE_ORDER_EU = ("eurlex_html",)
SOURCE_TYPES = ("fek_pdf", "topiko_fek", "kodikopoiimeno_html", "eurlex_html", "pdf_alli_pigi", "doc_alli_pigi", "sympliroma")
RELATIONS = ("antikathista", "antikatastathike_apo", "tropopoiei", "tropopoieitai_apo", "kodikopoiei", "kodikopoiithike_apo", "ensomatothike_me")

# Page parts that are no text, and where the text is, in order of preference.
DROPPED_TAGS = ("script", "style", "noscript", "nav", "header", "footer", "form", "button", "iframe", "svg")
CONTAINERS = ("#PP4Contents", ".eli-main-content", "#docHtml", "article", "main", "#content", ".content")

# Column search on pages.
LEAST_WORDS = 40
CROSSING_SHARE = 0.02
GUTTER_PERCENTS = (35, 65)

# What a run says of a law's sources.
SAYS_NO_FILE = "το αρχείο %s δεν υπάρχει"
SAYS_SCANNED = "το PDF δεν έχει επίπεδο κειμένου (σαρωμένο). Χρειάζεται OCR."
SAYS_BLANK = "δεν εξήχθη καθόλου κείμενο από %s (%d bytes, %s)"
SAYS_UNKNOWN_TYPE = "άγνωστος τύπος"
SAYS_NO_ARTICLES = "δεν εντοπίστηκε κανένα άρθρο. Πιθανή αιτία: αλλαγή διάταξης στην πηγή ή λάθος URL."
SAYS_NO_SOURCE = "%s: καμία διαθέσιμη πηγή"
SAYS_ONE_FAILED = "%s: %s"
SAYS_ALL_FAILED = "%s: καμία από τις %d πηγές δεν απέδωσε κείμενο — %s"
SAYS_LOCAL_COPY = "το et.gr δεν απάντησε — το κείμενο προέρχεται από το αντίγραφο ΦΕΚ του repository (%s), που είναι το ίδιο έγγραφο"
SAYS_OTHER_SOURCE = "η προτιμώμενη πηγή απέτυχε — το κείμενο προέρχεται από %s (%s)"
SAYS_UNVERIFIED = "τα στοιχεία ΦΕΚ δεν εντοπίστηκαν στην αρχή του κειμένου — ελέγξτε το pdf_id στο registry.yaml"
SAYS_REPEATED = "η πηγή γράφει δύο φορές τα άρθρα %s — κρατήθηκε η πρώτη γραφή"
SAYS_NO_SUPPLEMENT = "το συμπλήρωμα %s δεν διαβάστηκε: %s"
SAYS_SUPPLEMENTED = "άρθρα από συμπλήρωμα, όχι από την κύρια πηγή: %s"
LOCAL_COPY = "topiko_fek"
