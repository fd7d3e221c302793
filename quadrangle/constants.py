"""Results depend on them being exactly these."""

# --- fixed values: name variants under which a university may be stored,
#     in the order in which they are tried
UNIVERSITY_ALIASES = {
    "hassan2": ["hassan2", "hassan_ii", "Hassan II", "hassan_2"],
    "cadi_ayyad": ["cadi_ayyad", "Cadi Ayyad", "cadiayyad", "caddi_ayad", "kaddi_ayad"],
}

# --- fixed values: course detection and naming
COURSE_KEYWORDS = ["formation", "filiere", "filière", "programme", "cursus"]
PDF_STEM_PATTERN = r"([^/]+)\.pdf$"
COURSE_NAME_PATTERN = r"(?:Fili[eè]re[s]?_?)(.*)"

# --- fixed values: URL ending -> file type; anything else is "html"
FILE_TYPE_EXTENSIONS = {
    "pdf": ["pdf"],
    "image": ["jpg", "jpeg", "png", "gif", "webp", "svg", "bmp", "tiff"],
    "json": ["json", "csv", "xml", "txt"],
    "document": ["doc", "docx", "ppt", "pptx", "xls", "xlsx", "odt", "ods", "odp", "zip", "rar"],
    "skip": ["css", "js", "ico", "map", "woff", "ttf", "eot", "woff2"],
}

# --- fixed values: file type -> bucket, and buckets used by the other jobs
BUCKETS = {
    "html": "raw-web-html",
    "pdf": "raw-documents",
    "document": "raw-documents",
    "image": "raw-images",
    "json": "raw-json",
}
DEFAULT_BUCKET = "raw-web-html"
DOCUMENT_BUCKET = "raw-documents"
TEXT_BUCKET = "raw-json"

# --- fixed values: link and page tests
REJECTED_HREF_PREFIXES = ["#", "javascript", "mailto", "tel"]
DYNAMIC_MARKERS = [
    "callWS", "getTabs", "getPage", "angular", "react", "vue", "$(document).ready",
]

# --- fixed values: limits that are part of the jobs
MAX_CRAWL_DEPTH = 3

# --- fixed values: constant columns of the curated tables
PROFILE_SOURCE, PROFILE_LANGUAGE = "openalex_api", "en"
COURSE_SOURCE, COURSE_LANGUAGE = "file_extraction", "fr"
LANDING_SOURCE = "openalex"
EXTRACTION_TYPE = "text_extraction"
SIDECAR_SUFFIX = ".meta.json"
