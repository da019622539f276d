"""Hand-written VCF header and lines for parser tests."""

CSQ_FORMAT = "Allele|Consequence|SYMBOL|Existing_variation|gnomAD_exomes_AF|gnomAD_genomes_AF"

HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count">',
    '##INFO=<ID=AN,Number=1,Type=Integer,Description="Allele number">',
    '##INFO=<ID=BaseQRankSum,Number=1,Type=Float,Description="Rank sum, with, commas">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="dbSNP">',
    '##INFO=<ID=RAW_MQ,Number=1,Type=Float,Description="Raw MQ">',
    f'##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations from Ensembl VEP. Format: {CSQ_FORMAT}">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Allelic depths">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Likelihoods">',
    '##FORMAT=<ID=MIN_DP,Number=1,Type=Integer,Description="Min depth">',
    '##FORMAT=<ID=PID,Number=1,Type=String,Description="Phase id">',
    '##FORMAT=<ID=PGT,Number=1,Type=String,Description="Phase GT">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tNA-1\tNA-2",
]


def line(*fields):
    return "\t".join(str(f) for f in fields)


FULL = line(
    "chr1", 100, "rs1", "A", "G,T", 50.5, "PASS",
    "AC=1,2;AN=4;BaseQRankSum=-0.5;DB;RAW_MQ=60;"
    "CSQ=G|missense_variant&splice_region_variant|BRCA1|rs1&COSV1|1.2e-05|0.5,"
    "T|synonymous_variant|BRCA1|rs2|.|",
    "GT:AD:DP:PL:MIN_DP:PID:PGT", "0/1:3,4:7:0,10,100:5:p1:0|1", "./.:0,0:0:.:0::.",
)
MISSING = line("chr1", 200, ".", "C", ".", ".", ".", ".", "GT:AD:DP:PL", "0/0:1,0:1:0,3,30", "./.")
NO_CSQ = line("chr2", 300, "rs3", "G", "A", 10, "q10;LowQual", "AC=1;AN=2", "GT:DP", "1|1:9", "0/1:0")
AF_TEXT = line(
    "chr3", 400, "rs4", "T", "C", 1, "PASS",
    "AC=1;AN=2;CSQ=C|x|G1|rs4|1.2e-05|0.001,C|x|G2|rs5|.|0.001,C|x|G3|rs6||0.001,C|x|G4|rs7|0.1&0.2|0.001",
    "GT", "0/1", "0/0",
)
LINES = [FULL, MISSING, NO_CSQ, AF_TEXT]
