"""Job parameters and the fixed word tables."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# Words dropped when stopword removal is on.
STOPWORDS = (
    "yang", "ini", "itu", "adalah", "dengan", "untuk", "dari", "ke", "dalam", "pada", "sebagai",
    "oleh", "akan", "telah", "sudah", "atau", "dan", "juga", "saya", "kamu", "dia", "kami",
    "kalian", "mereka", "nya", "ku", "mu", "si", "sang", "para", "pak", "bu", "bapak", "ibu",
    "mas", "mbak",
)

# Informal word -> standard word, applied once per token (not transitive).
SLANG = {
    "gak": "tidak", "ga": "tidak", "nggak": "tidak", "ngga": "tidak",
    "emg": "emang", "emang": "memang",
    "bgt": "banget",
    "tp": "tapi",
    "trus": "terus",
    "udah": "sudah", "udh": "sudah",
    "krn": "karena",
    "dgn": "dengan",
    "utk": "untuk",
    "sm": "sama",
    "gt": "gitu", "gini": "begini", "gitu": "begitu",
    "klo": "kalau", "kalo": "kalau",
    "gmn": "gimana", "gimana": "bagaimana",
    "knp": "kenapa", "kenapa": "mengapa",
}

# Label names, and the columns of a labelled review table.
LABEL_NAMES = {0: "Negative", 1: "Positive"}
REQUIRED_COLUMNS = ("review", "sentimen")


@dataclass(frozen=True)
class CleanRules:
    """How text is cleaned and which rows survive preparation."""

    profile: str = "full"  # "full" or "basic"
    # The default patterns and bounds.
    lowercase: bool = True
    special_chars: str = r"[^a-zA-Z\s]"
    extra_whitespace: str = r"\s+"
    min_len: int = 5
    remove_duplicates: bool = True
    remove_stopwords: bool = False
    stopwords: tuple[str, ...] = STOPWORDS
    slang: dict[str, str] = field(default_factory=lambda: dict(SLANG))

    def to_dict(self) -> dict:
        out = asdict(self)
        out["stopwords"] = list(self.stopwords)
        return out

    def updated(self, values: dict) -> "CleanRules":
        """A copy with the given keys replaced; absent keys keep their value."""
        merged = {**self.to_dict(), **{k: v for k, v in values.items() if k in self.to_dict()}}
        merged["stopwords"] = tuple(merged["stopwords"])
        return CleanRules(**merged)


@dataclass(frozen=True)
class TrainParams:
    # The defaults of training.
    model_type: str = "logistic_regression"
    params: dict = field(default_factory=lambda: {"C": 1.0, "max_iter": 1000})
    k_features: int | None = 500
    leaky_selection: bool = False
    test_size: float = 0.2
    stratify: bool = True
    cv_folds: int = 3
    seed: int = 42
    dim: int = 768


@dataclass(frozen=True)
class IndexParams:
    index_type: str = "inner_product"  # or "l2"
    normalize: bool = True
    max_query_rows: int = 32_768
    max_broadcast_bytes: int = 64 << 20
