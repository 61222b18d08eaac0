"""Tables and names that results depend on. Data only."""

# Forms of the data set, in processing order.
FORMS = ["irsp", "irsv", "irsf", "irss", "ilum", "ilup", "amb", "irsrsd"]

# Routing order of form names; the first one contained in a file name wins.
ROUTE_ORDER = ["amb", "irss", "irsrsd", "irsv", "ilup", "irsf", "ilum", "irsp"]

# Ordered literal replacements for text damaged by a Mac-Roman round trip.
MOJIBAKE_REPLACEMENTS = [
    ("N√£o", "Não"),
    ("√£", "ã"),
    ("√∫", "ú"),
    ("√°", "á"),
    ("√≥", "ó"),
    ("√©", "é"),
    ("√â", "É"),
    ("√ö", "Õ"),
    ("√º", "ü"),
    ("√§", "ä"),
    ("√ß", "ç"),
    ("√≠", "í"),
    ("√µ", "õ"),
    ("√π", "ù"),
    ("√¥", "â"),
    ("√®", "è"),
    ("√´", "ê"),
    ("√∞", "à"),
    ("√±", "ñ"),
    ("√≠vel", "ível"),
    ("√£o", "ão"),
    ("N√£o Atende", "Não Atende"),
    ("Nã£o Atende", "Não Atende"),
    ("N√£o se aplica", "Não se aplica"),
    ("poss√≠vel", "possível"),
    ("avalia√ß√£o", "avaliação"),
    ("N√£o poss√≠vel avalia√ß√£o", "Não possível avaliação"),
]

# The 27 bytes between 80 and 9F that windows-1252 defines, and their characters.
WINDOWS_1252_BYTES = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e"
    "\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
)
WINDOWS_1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"

# Blanks removed by a Unicode-aware strip.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cells that a text table reader takes as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Latin ligatures and digraphs that the text fix spells out.
LIGATURES = [
    ("Ĳ", "IJ"), ("ĳ", "ij"), ("ŉ", "ʼn"),
    ("Ǆ", "DŽ"), ("ǅ", "Dž"), ("ǆ", "dž"),
    ("Ǉ", "LJ"), ("ǈ", "Lj"), ("ǉ", "lj"),
    ("Ǌ", "NJ"), ("ǋ", "Nj"), ("ǌ", "nj"),
    ("Ǳ", "DZ"), ("ǲ", "Dz"), ("ǳ", "dz"),
    ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "ſt"), ("ﬆ", "st"),
]

# Media kinds, the column-name keywords that select them and their id prefix.
MEDIA_KINDS = {
    "images": {
        "keywords": ["foto", "photo", "assinatura", "registrodaevidcia"],
        "id_column": "id_image",
        "prefix": "gridfs://registrationFiles/",
        "melted": True,
    },
    "videos": {
        "keywords": ["video"],
        "id_column": "id_video",
        "prefix": "gridfs://registrationFiles/",
        "melted": True,
    },
    "pdfs": {
        "keywords": ["pdf_file_id"],
        "id_column": "id_pdf",
        "prefix": None,
        "melted": False,
    },
}

# Column names of the gold layer.
SUBMISSION_ID = "moreapp_submission_id"
LINK_SUBMISSION = "submission_id"
LINK_URL = "url_presigned"
LINK_FORM = "formulario_moreapp"
MAIL_PDF = "mailStatuses_0_pdfFileId"
PDF_FILE_ID = "pdf_file_id"
PROCESSED_AT = "_processing_timestamp"

# Photo references in raw submissions, and the earliest submission date kept.
PHOTO_PREFIX = "gridfs://"
DATE_FLOOR = "2023-01-01 00:00:00"
PROCESSED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Mime type of a folder in a file listing.
FOLDER_MIME = "application/vnd.google-apps.folder"

# Length of a time unit in microseconds.
UNIT_MICROS = {
    "microseconds": 1,
    "milliseconds": 1_000,
    "seconds": 1_000_000,
    "minutes": 60_000_000,
    "hours": 3_600_000_000,
    "days": 86_400_000_000,
    "weeks": 604_800_000_000,
}
