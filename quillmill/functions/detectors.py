"""Vocabularies of the evidence detectors: fixed values, matched without regard to case."""

from __future__ import annotations

from quillmill.functions.text import has

NON_HUMAN = r"\bGS3\b|Grain Size 3|\bOryza\b|oryza sativa|haploid induction|\bZea mays\b|corn kernel|\bDaphnia\b|obligately asexual|asexual clone|\bdCREB2\b|\bdCREB\b"
NEGATED_CLAIM = r"no gain.of.function effect demonstrated|no GOF effect|not gain.of.function|did not demonstrate gain.of.function|(?:lacks?|show\s+no).{0,25}gain.of.function|no gain-of-function"
LOSS = (
    r"loss.of.function|loss-of-function|\bhaploinsufficienc|\bhaploinsufficient\b|\bnonfunctional\b|non.functional\b|locked.closed conformation|locked-closed|"
    r"does not induce.{0,30}current|\bno current\b|loss of MCT1|MCT1 loss|drastically diminish.{0,20}VRAC|diminish.{0,20}VRAC activity|emerin.{0,30}loss|loss.{0,30}emerin|"
    r"unable to encode.{0,30}full.length protein|loss of functional.{0,20}channel|reducing chloride efflux|reduced serum.{0,30}level|"
    r"decreased transcription activity|significantly decreased.{0,30}activity"
)
CLAIM = r"constitutiv.{0,25}activ|constitutively active|gain.of.function|gain of function|\bGOF\b|dominant.negative|neomorphic|toxic gain|hypermorph|activating mutation"
MISMATCH = r"loricrin|\bLOR\b|mutant loricrin"
BAD_SECTION = r"purchased from|taqman|pcr primer|biosystems|foster city|fax:|tel\.|e-mail:|\w+@\w+\.(edu|com)|department of.{0,40}medic|hospital,.{0,40}st\.|harvard medical|institute for|university of"
DECAY = r"\bNMD\b|nonsense.mediated"
NEW_FUNCTION = r"neomorp"
CLAIM_CONTEXT = r"gain.of.function|constitutiv.{0,20}activ|dominant.negative|toxic|aggregat|neomorphic|\bGOF\b|NMD.escape|hypermorph|activating.mutation"
FRAMESHIFT = r"fs"
STOP = r"Ter[0-9]|[*X][0-9]|Ter$|[*X]$"
EXTENSION = r"ext[*0-9A-Za-z]"
TIERS = [
    ("tier1", r"\bstop[- ]loss\b|\bnonstop[- ](?:extension|mutation|variant|change)\b|\bnon-?stop\s+(?:codon\s+)?(?:mutation|variant|extension)\b|\bloss\s+of\s+(?:the\s+)?stop\s+codon\b|\bstop\s+codon\s+(?:loss|elimination)\b"),
    ("tier2", r"\bext\*[0-9]+\b|\bextTer[0-9]+\b|\bext[A-Z][a-z]{2}\*[0-9]+\b|p\.\*[0-9]+[A-Za-z]+ext\b|p\.Ter[0-9]+[A-Za-z]+ext\b|\bp\.\([A-Z][a-z]{2}[0-9]+[A-Z][a-z]{2}ext"),
    ("tier3", r"C[- ]terminal\s+extension.{0,60}stop\s+codon|stop\s+codon.{0,60}C[- ]terminal\s+extension|protein\s+extension.{0,40}stop\s+codon|stop\s+codon\s+mutation.{0,60}extension|translational\s+readthrough\b|\breadthrough\s+(?:suppression|mutation|variant)\b"),
]
NOTATION_SENTENCE = r"[^.!?\n]{0,200}(?:c\.[0-9][A-Za-z0-9_>*+\-]+|p\.[A-Za-z]{1,3}[0-9][A-Za-z0-9_*]+)[^.!?\n]{0,200}[.!?\n]"

DETECTORS = {"non_human": NON_HUMAN, "negated_claim": NEGATED_CLAIM, "loss": LOSS, "claim": CLAIM, "mismatch": MISMATCH, "bad_section": BAD_SECTION, "decay": DECAY, "new_function": NEW_FUNCTION, "claim_context": CLAIM_CONTEXT}


def detected(text, **patterns: str):
    """A boolean column for each named pattern."""
    return [has(text, p).alias(name) for name, p in patterns.items()]
