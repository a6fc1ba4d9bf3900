"""Scoring and cleaning rule configuration.

The loan score is a set of first-match-wins bands. All points, thresholds,
weights and lookup lists live here as one frozen dataclass so a caller can
change a rule value without touching the operators; the operators turn the
config into plain ``CASE WHEN`` Columns that Catalyst constant-folds.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# Rule points, grade thresholds, weights and lookup lists of the
# analysed workload. They are the query semantics and must stay equal to it.
UNACCEPTABLE_RATED_PTS = 0
VERY_BAD_RATED_PTS = 100
BAD_RATED_PTS = 250
GOOD_RATED_PTS = 500
VERY_GOOD_RATED_PTS = 650
EXCELLENT_RATED_PTS = 800

UNACCEPTABLE_GRADE_PTS = 750
VERY_BAD_GRADE_PTS = 1000
BAD_GRADE_PTS = 1500
GOOD_GRADE_PTS = 2000
VERY_GOOD_GRADE_PTS = 2500

PAYMENT_HISTORY_WEIGHT = Decimal("0.20")
DEFAULTERS_HISTORY_WEIGHT = Decimal("0.45")
FINANCIAL_HEALTH_WEIGHT = Decimal("0.35")

SUB_GRADE_FACTORS = (Decimal("1"), Decimal("0.95"), Decimal("0.90"), Decimal("0.85"), Decimal("0.80"))

LOAN_PURPOSES = (
    "debt_consolidation", "credit_card", "home_improvement", "other",
    "major_purchase", "medical", "small_business", "car", "vacation", "moving",
    "house", "wedding", "renewable_energy", "educational",
)
OTHER_PURPOSE = "other"

MEMBER_KEY_COLUMNS = (
    "emp_title", "emp_length", "home_ownership", "annual_inc", "zip_code",
    "addr_state", "grade", "sub_grade", "verification_status",
)
MEMBER_KEY_SEPARATOR = "||"
ALL_NULL_MEMBER_KEY_PREFIX = "e3b0c44298fc1c149"

LOAN_STATUS_PATTERNS = (
    ("%fully paid%",),
    ("%current%",),
    ("%in grace period%",),
    ("%late (16-30 days)%", "%late (31-120 days)%"),
    ("%charged off%",),
)
HOME_OWNERSHIP_PATTERNS = ("%own", "%rent", "%mortgage", "%any")
CREDIT_LIMIT_RATIOS = (0.10, 0.20, 0.30, 0.50, 0.70)
STATE_CODE_MAX_LENGTH = 2
LONG_STATE_REPLACEMENT = "NA"
LOAN_TERM_SUFFIX = " months"


@dataclass(frozen=True)
class ScoreRules:
    """Points and thresholds of the loan score (defaults are the fixed values above)."""

    unacceptable: int = UNACCEPTABLE_RATED_PTS
    very_bad: int = VERY_BAD_RATED_PTS
    bad: int = BAD_RATED_PTS
    good: int = GOOD_RATED_PTS
    very_good: int = VERY_GOOD_RATED_PTS
    excellent: int = EXCELLENT_RATED_PTS

    unacceptable_grade: int = UNACCEPTABLE_GRADE_PTS
    very_bad_grade: int = VERY_BAD_GRADE_PTS
    bad_grade: int = BAD_GRADE_PTS
    good_grade: int = GOOD_GRADE_PTS
    very_good_grade: int = VERY_GOOD_GRADE_PTS

    payment_weight: Decimal = PAYMENT_HISTORY_WEIGHT
    defaulters_weight: Decimal = DEFAULTERS_HISTORY_WEIGHT
    financial_weight: Decimal = FINANCIAL_HEALTH_WEIGHT

    sub_grade_factors: tuple = SUB_GRADE_FACTORS
    zero_point_grades: tuple = ("F", "G")
    credit_limit_ratios: tuple = CREDIT_LIMIT_RATIOS

    # Points given when delinq_2yrs is above 5 or NULL. The workload uses the
    # *grade* threshold here (750), not a rated value; kept as written.
    delinq_over_5: int = UNACCEPTABLE_GRADE_PTS

    status_patterns: tuple = LOAN_STATUS_PATTERNS
    home_patterns: tuple = HOME_OWNERSHIP_PATTERNS

    grade_bases: tuple = field(default=None)

    def __post_init__(self):
        if self.grade_bases is None:
            object.__setattr__(self, "grade_bases", self.default_grade_bases())
        for name, expected in (("credit_limit_ratios", 5), ("status_patterns", 5), ("home_patterns", 4)):
            got = len(getattr(self, name))
            if got != expected:  # each bound has its own points; one without points would be lost
                raise ValueError(f"{name} needs {expected} entries, one for each of its points; got {got}")

    def default_grade_bases(self):
        return (("A", self.excellent), ("B", self.very_good), ("C", self.good), ("D", self.bad),
                ("E", self.very_bad))

    # Session-conf key suffix -> field, for the workload's named parameters
    CONF_KEYS = {
        "unacceptable_rated_pts": "unacceptable", "very_bad_rated_pts": "very_bad",
        "bad_rated_pts": "bad", "good_rated_pts": "good", "very_good_rated_pts": "very_good",
        "excellent_rated_pts": "excellent", "unacceptable_grade_pts": "unacceptable_grade",
        "very_bad_grade_pts": "very_bad_grade", "bad_grade_pts": "bad_grade",
        "good_grade_pts": "good_grade", "very_good_grade_pts": "very_good_grade",
    }

    @classmethod
    def from_conf(cls, spark, prefix: str = "spark.sql.", base: "ScoreRules | None" = None) -> "ScoreRules":
        """Rules with any of the named parameters set in the session conf
        (``spark.sql.excellent_rated_pts`` etc.) overriding ``base``.

        The delinquency fallback follows ``unacceptable_grade_pts`` unless
        ``base`` set it to something else, as in the workload's SQL."""
        base = base or cls()
        values = {}
        for suffix, name in cls.CONF_KEYS.items():
            raw = spark.conf.get(prefix + suffix, None)
            if raw is not None:
                value = Decimal(str(raw).strip())
                if value != value.to_integral_value():
                    raise ValueError(f"{prefix + suffix} must be a whole number of points, got {raw!r}")
                values[name] = int(value)
        if "unacceptable_grade" in values and base.delinq_over_5 == base.unacceptable_grade:
            values["delinq_over_5"] = values["unacceptable_grade"]
        fields = {f: getattr(base, f) for f in base.__dataclass_fields__}
        fields.update(values)
        if base.grade_bases == base.default_grade_bases():
            fields["grade_bases"] = None  # not set by the caller: follows the overridden points
        return cls(**fields)

    def sub_grade_points(self):
        """(grade, sub_grade, points) for every rated sub-grade, points as exact Decimals."""
        out = []
        for grade, base in self.grade_bases:
            for i, factor in enumerate(self.sub_grade_factors, start=1):
                out.append((grade, f"{grade}{i}", Decimal(base) * factor))
        return out

    def letter_bands(self):
        """(exclusive lower bound, letter) from best to worst; below the last is 'F'."""
        return (
            (self.very_good_grade, "A"),
            (self.good_grade, "B"),
            (self.bad_grade, "C"),
            (self.very_bad_grade, "D"),
            (self.unacceptable_grade, "E"),
        )


DEFAULT_RULES = ScoreRules()
