"""Settings of a run: frozen, validated, loadable from JSON, YAML and the environment."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field, fields, replace
from pathlib import Path
from typing import Any


def _share(name: str, value: float, low_open: bool = False) -> None:
    if not (0 < value if low_open else 0 <= value) or value > 1:
        raise ValueError(f"{name} must be between 0 and 1, got {value}")


#: Letters that a sequence has at least, before and after trimming.
SHORTEST = 100


# Fixed values from here on: the names of the settings and their defaults.
# max_n_content and min_coordinate_precision are kept for files that set them; nothing reads them.
@dataclass(frozen=True)
class Dereplication:
    clustering_threshold: float = 0.03
    clustering_method: str = "average"
    consensus_frequency_cutoff: float = 0.7
    min_sequence_length: int = 400
    max_n_content: float = 0.1
    min_post_trim_length: int = 300
    min_consensus_length_ratio: float = 0.75
    align_method: str = "star"
    trim_method: str = "gaps"

    def __post_init__(self):
        if not 0 < self.clustering_threshold < 1:
            raise ValueError(f"clustering_threshold must lie between 0 and 1, got {self.clustering_threshold}")
        _share("consensus_frequency_cutoff", self.consensus_frequency_cutoff, low_open=True)
        for k in ("max_n_content", "min_consensus_length_ratio"):
            _share(k, getattr(self, k))
        if self.clustering_method not in ("single", "complete", "average", "weighted", "ward"):
            raise ValueError(f"unknown clustering method {self.clustering_method!r}")
        if self.align_method not in ("star", "progressive"):
            raise ValueError(f"unknown alignment method {self.align_method!r}")
        if self.trim_method not in ("gaps", "similarity"):
            raise ValueError(f"unknown trim method {self.trim_method!r}")
        for k in ("min_sequence_length", "min_post_trim_length"):
            if getattr(self, k) < SHORTEST:
                raise ValueError(f"{k} must be at least {SHORTEST}, got {getattr(self, k)}")


@dataclass(frozen=True)
class GenotypeAssignment:
    min_identity: float = 0.5
    identity_method: str = "target_based"
    tie_margin: float = 0.003
    tie_threshold: float = 0.95

    def __post_init__(self):
        for k in ("min_identity", "tie_margin", "tie_threshold"):
            _share(k, getattr(self, k))
        if self.identity_method not in ("target_based", "classic"):
            raise ValueError(f"unknown identity method {self.identity_method!r}")


@dataclass(frozen=True)
class Taxonomy:
    min_identity_pct: float = 98.5
    min_query_cov_pct: float = 90.0
    top2_min_delta_pct: float = 0.5
    majority_species_threshold: float = 0.70
    allow_ambiguous_n_pct: float = 2.0

    def __post_init__(self):
        _share("majority_species_threshold", self.majority_species_threshold)


@dataclass(frozen=True)
class Geographic:
    exclude_centroids: bool = True
    exclude_zero_coords: bool = True
    exclude_missing: bool = True
    min_coordinate_precision: int | None = None
    validate_marine: bool = False


@dataclass(frozen=True)
class Visualization:
    facet_by: str = "species"
    map_buffer_degrees: float = 20.0
    show_bootstrap_threshold: float = 70.0

    def __post_init__(self):
        if self.facet_by not in ("species", "genotype"):
            raise ValueError(f"facet_by must be 'species' or 'genotype', got {self.facet_by!r}")


@dataclass(frozen=True)
class Phylogenetic:
    substitution_model: str = "GTR"
    n_bootstrap: int = 1000
    tree_algorithm: str = "linkage"
    midpoint_root: bool = True
    outgroup_fasta: str | None = None


@dataclass(frozen=True)
class Config:
    dereplication: Dereplication = field(default_factory=Dereplication)
    genotype_assignment: GenotypeAssignment = field(default_factory=GenotypeAssignment)
    taxonomy: Taxonomy = field(default_factory=Taxonomy)
    geographic: Geographic = field(default_factory=Geographic)
    visualization: Visualization = field(default_factory=Visualization)
    phylogenetic: Phylogenetic = field(default_factory=Phylogenetic)

    def update(self, **changes: Any) -> "Config":
        """``update(taxonomy__majority_species_threshold=0.6)``"""
        out = self
        for key, value in changes.items():
            part, _, name = key.partition("__")
            known = {f.name for f in fields(out)}
            if part not in known or name not in {f.name for f in fields(getattr(out, part))}:
                raise ValueError(f"unknown setting {key}")
            out = replace(out, **{part: replace(getattr(out, part), **{name: value})})
        return out

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict) -> "Config":
        flat = {f"{part}__{k}": v for part, inner in values.items() for k, v in (inner or {}).items()}
        return cls().update(**flat)

    def save(self, path: str) -> None:
        if path.endswith((".yaml", ".yml")):
            import yaml

            Path(path).write_text(yaml.safe_dump(self.to_dict(), sort_keys=False))
        else:
            Path(path).write_text(json.dumps(self.to_dict(), indent=2) + "\n")


def write_template(path: str) -> None:
    """The default settings, to be edited."""
    Config().save(path)


def load(path: str) -> Config:
    text = Path(path).read_text()
    if path.endswith((".yaml", ".yml")):
        import yaml

        return Config.from_dict(yaml.safe_load(text) or {})
    if path.endswith(".json"):
        return Config.from_dict(json.loads(text))
    raise ValueError(f"unknown kind of settings file: {path}")


def parse_value(text: str) -> Any:
    """'true', 'yes', '1' and 'on' are true, their opposites false, then numbers, 'none', texts."""
    low = text.strip().lower()
    if low in ("true", "yes", "1", "on"):
        return True
    if low in ("false", "no", "0", "off"):
        return False
    if low in ("none", "null", ""):
        return None
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def from_environment(prefix: str = "GENOFLUX_") -> Config:
    """``GENOFLUX_TAXONOMY__MAJORITY_SPECIES_THRESHOLD=0.6``"""
    changes = {k.removeprefix(prefix).lower(): parse_value(v) for k, v in os.environ.items() if k.startswith(prefix) and "__" in k.removeprefix(prefix)}
    return Config().update(**changes)


def warnings(config: Config) -> list[str]:
    """Settings that are allowed but unusual."""
    out = []
    if config.dereplication.clustering_threshold > 0.05:
        out.append("a clustering threshold over 0.05 may join species")
    if config.genotype_assignment.min_identity < 0.8:
        out.append("a minimum identity under 0.8 assigns distant sequences")
    if config.taxonomy.majority_species_threshold < 0.5:
        out.append("a majority under one half is no majority")
    if config.dereplication.min_sequence_length < 200:
        out.append("sequences under 200 letters carry little signal")
    return out
