"""A small invented graph with the shapes that the engine handles."""

HEAD = """@prefix kg: <http://example.org/kg#> .
@prefix v: <http://example.org/kg-schema#> .
@prefix skos: <http://www.w3.org/2004/02/skos/core#> .
@prefix dct: <http://purl.org/dc/terms/> .
@prefix owl: <http://www.w3.org/2002/07/owl#> .
@prefix prov: <http://www.w3.org/ns/prov#> .
@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
"""

FILES = {
    "concepts.ttl": """
kg:Concept.Tide a v:Concept, owl:NamedIndividual ; skos:prefLabel "Tide"@en ; skos:definition "Water goes # up"@en ; dct:subject kg:Subject.Sea ; v:influencedBy kg:Persona.Ada .
kg:Concept.Wave a v:Concept ; skos:prefLabel "Wave"@en ; skos:definition "Water moves"@en ; v:convergesWith kg:Concept.Tide ; .
kg:Concept.Salt a v:Concept ; skos:prefLabel "Salt"@en ; skos:definition "Taste"@en .
""",
    "people.ttl": """
kg:Human.Ada a v:Human ; skos:prefLabel "Ada"@en ; v:memberOf kg:Organization.Club ; owl:sameAs <http://ext.example/Ada_(x)> .
kg:Persona.Ada a v:Persona ; v:actsThrough kg:Human.Ada ; skos:prefLabel "Ada"@en .
kg:Persona.Bo a v:Persona ; skos:prefLabel "Bo"@en .
""",
    "organizations.ttl": 'kg:Organization.Club a v:Organization ; skos:prefLabel "Club"@en .',
    "subjects.ttl": "kg:Subject.Sea a v:Subject ; v:broader kg:Subject.Top ; skos:broader kg:Subject.Top . kg:Subject.Top a v:Subject .",
    "episodes.ttl": """
kg:Episode.One a v:Episode ; v:discusses kg:Concept.Tide ; v:hasGuest kg:Persona.Ada, kg:Persona.Bo ; dct:created "2020-01-02"^^xsd:date ; dct:issued "2020-01-01"^^xsd:date ; v:isPartOf kg:Series.S ; v:seriesPosition 2 .
kg:Interview.Two a v:Episode ; v:isPartOf kg:Series.S ; v:seriesPosition 1 .
kg:Series.S v:hasPart kg:Episode.One .
""",
    "links.ttl": """
kg:LinkNote.TideAda a v:LinkNote ; v:aboutSubject kg:Concept.Tide ; v:aboutObject kg:Persona.Ada ; v:hasEvidence kg:Evidence.1, kg:Evidence.2 ; v:calculatedConfidence v:ConfidenceType.Candidate .
kg:LinkNote.WaveBo a v:LinkNote ; v:aboutSubject kg:Concept.Wave ; v:aboutObject kg:Persona.Bo ; v:hasEvidence kg:Evidence.3 .
kg:LinkNote.None a v:LinkNote .
""",
    "evidence.ttl": """
kg:Evidence.1 a v:Evidence ; v:confidence v:ConfidenceType.Curated ; v:evidencePolarity v:PolarityType.Supports ; dct:description "why"@en ; v:aboutSource kg:Source.S .
kg:Evidence.2 a v:Evidence ; v:confidence v:ConfidenceLevel.Curated ; v:evidencePolarity v:EvidencePolarity.Supports ; dct:description "because"@en .
kg:Evidence.3 a v:Evidence ; v:confidence v:ConfidenceType.Curated ; v:evidencePolarity v:PolarityType.Contests ; dct:description "no"@en .
kg:Evidence.4 a v:Evidence ; prov:wasRevisionOf kg:Evidence.3 .
kg:Source.S a v:Source ; skos:prefLabel "S" ; v:reliabilityTier v:ReliabilityTier.Authoritative .
""",
    "relationships.ttl": """
kg:Relationship.AB a v:Relationship ; v:hasSubject kg:Persona.Ada ; v:hasObject kg:Persona.Bo ; v:hasRelationshipType v:T.B, v:T.A ;
  v:hasInteraction [ a v:Appearance ; v:subjectRole v:Role.Host ] , [ a v:Appearance ; v:subjectRole v:Role.Guest ; v:year "1999"^^xsd:gYear ] .
""",
    "enumerations.ttl": """
v:ConfidenceType owl:equivalentClass [ owl:oneOf ( v:ConfidenceType.Curated v:ConfidenceType.Candidate ) ] .
v:ConfidenceType.Curated skos:prefLabel "Curated"@en . v:ConfidenceType.Candidate skos:prefLabel "Candidate"@en .
""",
    "scratch.ttl": '<http://example.org/scratch> a owl:Ontology ; dct:title "x" ; dct:note "y", "z" .',
}


def write(folder):
    folder.mkdir(exist_ok=True)
    for name, body in FILES.items():
        (folder / name).write_text(HEAD + body, encoding="utf-8")
    (folder / "broken.ttl").write_text(HEAD + "kg:X v:p [ .", encoding="utf-8")
    return str(folder)
