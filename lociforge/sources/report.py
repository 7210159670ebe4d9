"""Reports of one sample's result document: Markdown, and the same as an HTML page.

Without a panel every gene of the document is shown, by name; with one, its genes in the panel's order, ``Not tested`` where the document has none of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from html import escape

from lociforge.sources.config import FusionRules

_ARROWS = {"left": "<<", "right": ">>"}


@dataclass(frozen=True)
class Panel:
    """What of a panel configuration a report uses."""

    focal: Sequence[str] = ()
    local: Sequence[str] = ()
    deletions: Sequence[str] = ()
    duplications: Sequence[str] = ()
    insertions: Mapping[str, Mapping] = field(default_factory=dict)
    drugs: Sequence[str] = ()
    disease: Sequence[str] = ()
    transcripts: Mapping[str, Mapping] = field(default_factory=dict)
    rules: FusionRules | None = None
    fusion_reads: int = 3
    breakpoint_reads: int = 3


def read_panel(got: Mapping, rules: FusionRules | None = None) -> Panel:
    """The report's part of a parsed panel configuration; absent entries are empty."""
    genes, cuts = got.get("genes", {}), got.get("thresholds", {}).get("fusions", {})
    cnv, snv = genes.get("cnv", {}), genes.get("snv", {})
    return Panel(
        cnv.get("focal_genes", ()), cnv.get("local_cn_genes", ()), cnv.get("deletion_genes", ()), cnv.get("duplication_genes", ()), genes.get("itd", {}),
        snv.get("pharmacogenomics", ()), snv.get("pathogenic", ()), snv.get("transcripts", {}), rules, cuts.get("min_supporting_reads", 3), cuts.get("min_breakpoint_reads", 3),
    )


def _part(document: Mapping, section: str, key: str):
    return (document.get(section) or {}).get(key)


def _table(head: Sequence[str], rows: Iterable[Sequence]) -> list[str]:
    cells = lambda row: "| " + " | ".join(str(c).replace("|", "\\|") for c in row) + " |"
    return [cells(head), "|" + "---|" * len(head), *map(cells, rows)]


def shown_fusions(document: Mapping, panel: Panel | None = None) -> list[Mapping]:
    """Fusions off the blacklist with enough reads; one with breakpoints needs a supported one unless a gene's name holds a part that the panel exempts from self-fusions."""
    panel = panel or Panel()
    rules = panel.rules
    listed = {frozenset(p) for p in rules.blacklist} if rules else set()
    exempt = rules.skip_self if rules else ()

    def fits(f: Mapping) -> bool:
        names = (f["gene1"]["name"], f["gene2"]["name"])
        if all(names) and frozenset(names) in listed or f["supporting_reads"] < panel.fusion_reads:
            return False
        special = any(part in name for part in exempt for name in names)
        return special or not f["breakpoints"] or any(b["n_reads"] >= panel.breakpoint_reads for b in f["breakpoints"])

    return [f for f in _part(document, "fusions", "fusions") or [] if fits(f)]


def _gene(g: Mapping) -> str:
    return f"{g['name']} ({g['chr']} ~{g['pos'] / 1e6:.2f}Mbp)" if g["chr"] and g["pos"] else g["name"]


def _breakpoint(b: Mapping) -> str:
    sides = [f"{b[f'gene{k}_chr']}:{b[f'gene{k}_pos']}{_ARROWS[b[f'gene{k}_dir']]}" for k in (0, 1)]
    gap = b.get("overlap_gap") or 0
    return f"{sides[0]} -- {sides[1]}  ({b['n_reads']} reads{f' [{abs(gap)}bp {"hom" if gap > 0 else "ins"}]' if gap else ''})"


def _fusion_lines(document: Mapping, panel: Panel | None) -> list[str]:
    found = shown_fusions(document, panel)
    kinds = {True: [f for f in found if f["gene1"]["name"] and f["gene2"]["name"]], False: [f for f in found if not (f["gene1"]["name"] and f["gene2"]["name"])]}
    out = ["## Gene fusions"]
    for both, none in ((True, "**No fusions detected**"), (False, "**None detected**")):
        rows = [(_gene(f["gene1"]), _gene(f["gene2"]), f"**{f['supporting_reads']}**" if f["supporting_reads"] >= 3 else f["supporting_reads"], "; ".join(map(_breakpoint, f["breakpoints"]))) for f in kinds[both]]
        out += ["", *([] if both else ["### Rearrangements with only one side in the panel", ""]), *(_table(("Gene/region 1", "Gene/region 2", "Supporting reads", "Breakpoints"), rows) if rows else [none])]
    return out


def _karyotype_lines(document: Mapping, figure: str | None) -> list[str]:
    k = document.get("karyotype")
    out = ["## Gains and losses of chromosomes and arms", ""]
    if not k:
        return [*out, "Not run"]
    out += [f"> **WARNING:** {line}" for line in (k.get("warnings") or "").split("\n") if line]
    out += [f"Digital karyotype: **{k['karyotype_string']}**", "", f"ISCN nomenclature: **{k['iscn_string']}**"]
    if k.get("blast_ratio") is not None:
        out += ["", f"Blast ratio (tumor fraction): **{100 * k['blast_ratio']:.2f}%**"]
    return out + (["", f"![Karyotype]({figure})"] if figure else [])


def _copies(kind: str, value: float) -> str:
    whole = int(abs(value) + 0.5) * (1 if value >= 0 else -1)  # halves away from zero
    return f"{kind} copy number estimate: **{whole}x ({value:.1f}x)**"


def _spans(found: Sequence[Mapping] | None) -> list[str]:
    return [f"{v.get('chrom') or '?'}: {v['start']} - {v['end']} ({v['end'] - v['start']} nt): **{v['reads']} supporting reads**" for v in found or []] or ["None detected"]


def _copy_lines(document: Mapping, panel: Panel | None) -> list[str]:
    genes = _part(document, "cnv", "genes") or {}
    local = lambda one: [_copies("Local read-depth based", one["local"])] if one.get("local") is not None else []
    focal = lambda one: [_copies("Focal sequencing-depth based", one["focal"])] if one.get("focal") is not None else []
    blocks: list[tuple[str, list[str]]] = []
    if panel is None:
        for gene, one in sorted(genes.items()):
            lines = local(one) + focal(one)
            for kind in ("deletions", "duplications"):
                lines += [f"**Intragenic {kind}:**", *_spans(one[kind])] if one.get(kind) else []
            blocks.append((gene, lines))
    else:
        blocks += [(g, local(genes[g]) if g in genes else ["Not tested"]) for g in panel.local]
        for gene in (g for g in panel.focal if g not in panel.local):
            if gene not in panel.deletions:
                blocks.append((gene, focal(genes[gene]) if gene in genes else ["Not tested"]))
            elif gene in genes and not genes[gene].get("deletions"):  # a deletion speaks for itself below
                blocks.append((gene, focal(genes[gene])))
        for kind, listed, title in (("deletions", panel.deletions, "intragenic deletions"), ("duplications", panel.duplications, "intragenic tandem duplications")):
            blocks += [(f"{g} {title}", _spans(genes[g].get(kind)) if g in genes else ["Not tested"]) for g in listed]
    return ["## Focal copy-number variation", *[line for title, lines in blocks for line in ("", f"### {title}", *[x for text in lines for x in ("", text)])]]


def _insertion_lines(document: Mapping, panel: Panel | None) -> list[str]:
    genes = _part(document, "itd", "genes") or {}
    out = ["## Insertions and internal tandem duplications"]
    for gene in sorted(genes if panel is None else panel.insertions):
        label = "ITD" if panel is None else panel.insertions[gene].get("label", "ITD")
        out += ["", f"### {gene} {label}"]
        for e in genes.get(gene) or []:
            others = e["coverage"] - e["merged"] if e["coverage"] > e["merged"] else e["coverage"]
            out += ["", f"{e['length']} nt insertion at position {e['position']}: {e['merged']} reads (of {e['coverage']}); {e['merged'] / others if others else float('inf'):.2f} AR"]
        out += [] if genes.get(gene) else ["", "None detected"]
    return out


def _variant_lines(document: Mapping, panel: Panel | None) -> list[str]:
    genes = _part(document, "snv", "genes") or {}
    groups = [("", sorted(genes))] if panel is None else [("Disease variants", panel.disease), ("Pharmacogenomic variants", panel.drugs)]
    out = ["## Small variants and genotypes"]
    for title, names in groups:
        out += ["", f"### {title}"] if title and names else []
        for name in names:
            one = genes.get(name)
            out += ["", f"**{name}**", ""]
            if one is None:
                out.append("Not tested")
                continue
            out += [f"Sequencing depth: {one['coverage']:.2f}x", ""] if one.get("coverage") is not None else []
            out += ["Mutations:", "", *([f"- {m}: {share} AF" for m, share in one["mutations"].items()] or ["(none detected)"]), ""]
            out += ["Amino acid changes:", "", *[f"- {a}" for a in one["aa_changes"]], ""] if one["aa_changes"] else []
            out.append(f"Genotype: **{one['genotype']}**")
    return out


def _quality_lines(document: Mapping) -> list[str]:
    q = document.get("qc") or {}
    reads = q.get("reads_aligned", _part(document, "karyotype", "reads_aligned"))
    out = ["## Quality control metrics", ""] + ([f"- Genome-wide reads aligned: **{reads:,}**"] if reads is not None else [])
    out += [f"- Mean on-target read length: **{int(q['nt_on_target'] / q['reads_on_target'])} nt**"] if q.get("reads_on_target") else []
    return out + ([f"- Mean coverage over target regions: **{q['nt_on_target'] / q['target_regions_nt']:.2f}x**"] if q.get("target_regions_nt") else [])


_DETAILS = {"run_start_time": "Date/time of sequencing start", "run_id": "Run ID", "basecall_model": "Basecalling model", "library_id": "Library ID", "sequencer_id": "Sequencer ID", "flow_cell_id": "Flow cell ID"}


def _detail_lines(document: Mapping) -> list[str]:
    found = [(title, _part(document, "metadata", key)) for key, title in _DETAILS.items()]
    return ["## Sequencing details", *[x for title, v in found if v is not None for x in ("", f"**{title}:** {v}")]] if any(v is not None for _, v in found) else []


def _method_lines(panel: Panel, targets: Sequence[str]) -> list[str]:
    out = ["## Methodology", "", "**Karyotype:** copies per arm follow from read counts per bin, one count a read where it starts, and from minor allele frequencies.", "", "**Insertions**"]
    for gene, one in sorted(panel.insertions.items()):
        share = f", at least {100 * one['min_frequency']:.0f}% of the reads" if one.get("min_frequency") else ""
        out += ["", f"- {gene}: {one['chrom']}:{one['start']}-{one['end']}, {one.get('min_length', 3)} bp or longer{share}"]
    other = sorted(set(panel.transcripts) - set(panel.drugs) - set(panel.disease))
    for title, names in (("Pharmacogenomics", sorted(panel.drugs)), ("Pathogenic variants", sorted(panel.disease)), ("Variants that define disease or subtype", other)):
        out += ["", f"**{title}**", ""] if names else []
        for name in names:
            one = panel.transcripts.get(name, {})
            out.append(f"- {name}" + (f" ({one['transcript']})" if one.get("transcript") else "") + (f": {', '.join(sorted(one['variants']))}" if one.get("variants") else ""))
    for title, names in (("Focal genes", panel.focal), ("Deletion screening", panel.deletions), ("Duplication screening", panel.duplications)):
        out += ["", f"{title}: {', '.join(sorted(names))}"] if names else []
    if panel.rules and panel.rules.one_sided:
        partners = lambda g: f"partners: {', '.join(sorted(panel.rules.partners[g]))}" if g in panel.rules.partners else "any partner"
        out += ["", "**Fusions with one side in the panel**", "", *[f"- {g} ({partners(g)})" for g in sorted(panel.rules.one_sided)]]
    return out + (["", f"**Target genes:** {', '.join(sorted(set(targets)))}"] if targets else [])


def markdown(document: Mapping, panel: Panel | None = None, targets: Sequence[str] = (), figure: str | None = None) -> str:
    """All sections of one result; methods and the distinct target genes close it if there is a panel."""
    head = [f"# Variant report {document.get('timestamp', '')}".rstrip(), "", f"Version {document.get('version', '?')}"]
    parts = [head, _fusion_lines(document, panel), _karyotype_lines(document, figure), _copy_lines(document, panel), _insertion_lines(document, panel), _variant_lines(document, panel), _quality_lines(document), _detail_lines(document)]
    parts += [_method_lines(panel, targets)] if panel else []
    return "\n\n".join("\n".join(p) for p in parts if p) + "\n"


def _inline(text: str) -> str:
    return re.sub(r"\*\*(.+?)\*\*", r"<b>\1</b>", escape(text))


def html(text: str) -> str:
    """The Markdown of ``markdown`` as a page: headings, tables, lists, figures and paragraphs, with text escaped."""
    out, inside = [], ""
    for line in text.splitlines():
        kind = "table" if line.startswith("|") else "ul" if line.startswith("- ") else ""
        if kind != inside:
            out += ([f"</{inside}>"] if inside else []) + ([f"<{kind}>"] if kind else [])
            cell, inside = "th", kind
        if line.startswith("|---"):
            cell = "td"
        elif kind == "table":
            cells = re.split(r"(?<!\\)\|", line[1:-1])
            out.append("<tr>" + "".join(f"<{cell}>{_inline(c.strip().replace(chr(92) + '|', '|'))}</{cell}>" for c in cells) + "</tr>")
        elif kind == "ul":
            out.append(f"<li>{_inline(line[2:])}</li>")
        elif head := re.match(r"(#+) (.*)", line):
            out.append(f"<h{len(head[1])}>{_inline(head[2])}</h{len(head[1])}>")
        elif image := re.fullmatch(r"!\[(.*)\]\((.*)\)", line):
            out.append(f'<img alt="{escape(image[1])}" src="{escape(image[2])}">')
        elif line:
            out.append(f"<p>{_inline(line.removeprefix('> '))}</p>")
    return "<!DOCTYPE html><html><body>" + "\n".join(out + ([f"</{inside}>"] if inside else [])) + "</body></html>"
