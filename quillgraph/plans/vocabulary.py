"""IRIs of a curated knowledge graph, as one configurable vocabulary."""

from __future__ import annotations

from dataclasses import dataclass

#: Public namespaces.
SKOS = "http://www.w3.org/2004/02/skos/core#"
DCT = "http://purl.org/dc/terms/"
OWL = "http://www.w3.org/2002/07/owl#"
PROV = "http://www.w3.org/ns/prov#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"


@dataclass(frozen=True)
class Vocabulary:
    """Names of enumerations are fixed values. instances and schema: namespaces. families: accepted enumeration prefixes, the first of each is what is written."""

    instances: str = "http://example.org/kg#"
    schema: str = "http://example.org/kg-schema#"
    confidence: tuple[str, ...] = ("ConfidenceType", "ConfidenceLevel")
    tier: tuple[str, ...] = ("ReliabilityType", "ReliabilityTier")
    polarity: tuple[str, ...] = ("PolarityType", "EvidencePolarity")

    def members(self, family: tuple[str, ...], *names: str) -> list[str]:
        return [f"<{self.schema}{f}.{n}>" for f in family for n in names]

    def member(self, family: tuple[str, ...], name: str) -> str:
        return f"<{self.schema}{family[0]}.{name}>"

    def prefixes(self) -> str:
        names = {"kg": self.instances, "v": self.schema, "skos": SKOS, "dct": DCT, "owl": OWL, "prov": PROV, "rdfs": RDFS}
        return "".join(f"PREFIX {k}: <{v}>\n" for k, v in names.items())
