"""They must equal the published coding schemes for results to agree."""

from __future__ import annotations

# --- Fixed values: names written to the ``source`` column -----------------------------------
SOURCE_CODED_STATEMENTS = "federer_data_2018"
SOURCE_TYPED_STATEMENTS = "grant_impact_2018"
SOURCE_OBSERVED_FLAGS = "jones_observed_2025"
SOURCE_MEDICAL_PREPRINTS = "mcguinness_descriptive_2021"
SOURCE_CODED_JOURNALS = "karcher_replication_2025"
SOURCE_ANNOTATION_TOOL = "label_studio"
SOURCE_VENUE_RANKING = "gscholar_venues"

# --- Fixed values: cell contents a CSV reader treats as missing -----------------------------
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# --- Fixed values: statement codes to categories --------------------------------------------
STATEMENT_CODES = {
    "in paper and si": "available_paper_si",
    "in paper": "available_paper",
    "repository": "available_repository",
    "access restricted": "restricted",
    "combination": "available_mixed",
    "upon request": "upon_request",
    "in si": "available_si",
    "location not stated": "available_unspecified",
    "other": "other",
}
STATEMENT_TYPES = {
    1.0: "upon_request",
    2.0: "available_paper_si",
    3.0: "available_repository",
    4.0: "available_paper_si",
}
FLAG_LABELS = {"yes": "yes", "no": "no"}
FLAG_CATEGORIES = {"yes": "has_statement", "no": "no_statement"}
CHOICE_CATEGORIES = {"yes": "has_statement", "no": "no_statement", "maybe": "uncertain"}

# --- Fixed values: keyword cascades, first match wins ---------------------------------------
CASCADE_MEDICAL = (
    ("upon_request", ("upon request", "on reasonable request")),
    ("available_paper_si", ("supplementary", "within the article", "included within")),
    ("available_repository", ("repository", "publicly available", "public domain")),
    ("not_applicable", ("not applicable",)),
    ("not_available", ("not available", "no empirical data")),
)
CASCADE_JOURNALS = (
    ("available_paper_si", ("within the paper", "within the manuscript", "supporting information")),
    ("available_repository", ("publicly available", "repository", "webpages")),
    ("upon_request", ("upon request", "on request")),
    ("not_available", ("cannot be shared", "not available")),
)

# --- Fixed values: labels used by earlier annotation rounds ---------------------------------
OLD_LABELS = {"data availability statement": "yes", "not": "no"}
CODE_LABELS = {1: "yes", 2: "no", 3: "maybe"}
LABELS = ("yes", "no", "maybe")

# --- Fixed values: venue display names to ranking names -------------------------------------
VENUE_ALIASES = {
    "Review of Financial Studies": "the review of financial studies",
    "Applied Catalysis B-environmental": "applied catalysis b: environmental",
    "Journal of energy & environmental sciences": "energy & environmental science",
    "Journal of materials chemistry. A, Materials for energy and sustainability": "journal of materials chemistry a",
    "The American Economic Review": "american economic review",
    "Quarterly Journal of Economics": "the quarterly journal of economics",
    "Journal of Finance": "the journal of finance",
    "Physical Review X": "physical review. x",
    "European Physical Journal C": "the european physical journal c",
    "Nature Reviews Molecular Cell Biology": "nature reviews. molecular cell biology",
    "Journal of Religion & Health": "journal of religion and health",
    "Lancet Oncology": "the lancet oncology",
    "Lancet Infectious Diseases": "the lancet infectious diseases",
    "Astronomy and Astrophysics": "astronomy & astrophysics",
    "Light-Science & Applications": "light: science & applications",
    "Energy research and social science": "energy research & social science",
    "Global Environmental Change-human and Policy Dimensions": "global environmental change",
    "Journalism: Theory, Practice & Criticism": "journalism",
}
MANUAL_ISSN_L = ("1063-6919", "1364-0321", "2159-5399", "1520-6149")
EXCLUDED_VENUE = "ieee/cvf international conference on computer vision"

# --- Fixed values: keywords and sizes of the annotation projects ----------------------------
STATEMENT_KEYWORDS = ("data",)
SOFTWARE_KEYWORDS = ("code", "software")
SAMPLE_PER_VENUE = 1000
MIN_WORDS, MAX_WORDS = 5, 1000
TASKS_PER_ANNOTATOR = 200
SIMILARITY_THRESHOLD = 0.85
EMBED_BATCH = 32
TEST_FRACTION = 0.2
SEED = 42
MAX_TOKENS = 512

# --- Fixed values: chat formats as (before, after) the message, by role ---------------------
CHAT_FORMATS = {
    "llama3.2": {
        "system": ("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n", "<|eot_id|>"),
        "user": ("<|start_header_id|>user<|end_header_id|>\n\n", "<|eot_id|>"),
        "assistant": ("<|start_header_id|>assistant<|end_header_id|>\n\n", "<|eot_id|>"),
    },
    "qwen": {
        "system": ("<|im_start|>system\n", "<|im_end|>\n"),
        "user": ("<|im_start|>user\n", "<|im_end|>\n"),
        "assistant": ("<|im_start|>assistant\n", "<|im_end|>"),
    },
    "gemma": {
        "user": ("<start_of_turn>user\n", "<end_of_turn>\n"),
        "assistant": ("<start_of_turn>model\n", "<end_of_turn>"),
    },
    "gpt-oss": {
        "system": ("<|start|>system<|message|>", "<|end|>"),
        "user": ("<|start|>user<|message|>", "<|end|>"),
        "assistant": ("<|start|>assistant<|channel|>final<|message|>", "<|end|>"),
    },
    "generic": {
        "system": ("<|system|>\n", "<|end|>\n"),
        "user": ("<|user|>\n", "<|end|>\n"),
        "assistant": ("<|assistant|>\n", "<|end|>"),
    },
}
SYSTEM_MESSAGE = (
    "You are an expert at identifying data availability statements in scientific text. "
    "A data availability statement describes where research data can be found or how it can be accessed."
)
INSTRUCTION = (
    "Determine if the following text contains a data availability statement. Answer with 'yes' or 'no'."
)

# --- Fixed values: the few-shot classification prompt ---------------------------------------
PROMPT_BEFORE = """You are an expert at analyzing scientific text for data availability statements.

A data availability statement describes where research data can be found, accessed, or obtained. This includes:
- References to data repositories or databases
- Statements about data sharing policies  
- Information about how to access the research data
- Contact information for data requests

# Examples

TEXT: We thank A. Sachraida, C. Gould and P. J. Kelly for providing us with the experimental data and helpful comments, and S. Tomsovic for a critical discussion.
RESULT: yes

TEXT: River discharge data for the Tully River were obtained from the Queensland Bureau of Meteorology (http://www.bom.gov.au). Data were obtained from the box centered on 17.5°S and 146°E from the SODA reanalysis project.
RESULT: yes

TEXT: The current results should be considered relative to a few study limitations. Officers may engage in proactive work that is not captured in these data.
RESULT: no

# Task

Analyze the following text and determine if it contains a data availability statement.
Answer with "yes", "no", or "maybe".

TEXT: """
PROMPT_AFTER = "\nRESULT: "
