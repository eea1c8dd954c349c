"""Fixed configuration values of the release build.

These lists must equal the published release conventions, so they are
stated here verbatim, in their natural order.  The final column lists
(161-319 names per table) are job parameters: pass them with
``read_names`` from the release's settings folder.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Crosswalks, (release name, source name) pairs.  A source
# listed twice maps to its last release name.
# ---------------------------------------------------------------------------
CROSSWALK_EZ = [
    ("TAXPER", "a_tax_prd"), ("TAXPER", "tax_pd"), ("TAXPER", "tax_prd"), ("TAXPER", "taxprd"),
    ("OTHCHGS", "othrchgsnetassetfnd"), ("Q78A", "unrelbusincd"), ("INITFEES", "initiationfee"),
    ("GRRECPUB", "grspublicrcpts"), ("CONT", "totcntrbs"), ("INVINC", "othrinvstinc"),
    ("SALEOTHG", "grsamtsalesastothr"), ("SALEOTHE", "basisalesexpnsothr"),
    ("SALEOTHN", "gnsaleofastothr"), ("GRSINCFNDRSNG", "grsrevnuefndrsng"),
    ("DIREXP", "direxpns"), ("INVENTG", "grsalesminusret"), ("GOODS", "costgoodsold"),
    ("GRPROF", "grsprft"), ("OTHINC", "othrevnue"), ("TOTREV2", "totrevnue"),
    ("EXPS", "totexpns"), ("NETINC", "totexcessyr"), ("ASS_EOY", "totassetsend"),
    ("LIAB_EOY", "totliabend"), ("FUNDBAL", "totnetassetsend"), ("REASON", "nonpfrea"),
]
CROSSWALK_FULL = [
    ("TAXPER", "tax_prd"), ("TAXPER", "tax_pd"), ("SUBSECCD", "subcd"), ("Q78A", "unrelbusinccd"),
    ("INITFEES", "initiationfees"), ("GRRECPUB", "grsincmembers"), ("GRRECMEM", "grsincmembers"),
    ("GRRECOTH", "grsincother"), ("CONT", "totcntrbgfts"), ("PROGREV", "totprgmrevnue"),
    ("INVINC", "invstmntinc"), ("NETRENT", "netrntlinc"), ("SECUR", "grsalesecur"),
    ("SALEOTHG", "grsalesothr"), ("SALESEXP", "cstbasisecur"), ("SALEOTHE", "cstbasisothr"),
    ("SALESECN", "gnlsecur"), ("SALEOTHN", "gnlsothr"), ("INVENTG", "grsalesinvent"),
    ("GOODS", "lesscstofgoods"), ("GRPROF", "netincsales"), ("OTHINC", "miscrevtot11e"),
    ("TOTREV2", "totrevenue"), ("COMPENS", "compnsatncurrofcr"), ("OTHSAL", "othrsalwages"),
    ("PAYTAX", "payrolltx"), ("FUNDFEES", "profndraising"), ("EXPS", "totfuncexpns"),
    ("ASS_EOY", "totassetsend"), ("BOND_EOY", "txexmptbndsend"), ("MRTG_EOY", "secrdmrtgsend"),
    ("LIAB_EOY", "totliabend"), ("RETEARN", "retainedearnend"), ("FUNDBAL", "totnetassetend"),
    ("REASON", "nonpfrea"),
]

# ---------------------------------------------------------------------------
# Fixed values: "drop if missing all of" lists (names as listed; they pass
# through the crosswalk before use).
# ---------------------------------------------------------------------------
DROP_IF_EMPTY_EZ = [
    "INVINC", "SALEOTHG", "SALEOTHE", "SALEOTHN", "GRSINCFNDRSNG", "NETINCFNDRSNG",
    "GRSINCGAMING", "INVENTG", "GOODS", "GRPROF", "OTHINC", "TOTREV2", "EXPS", "OTHCHGS",
    "ASS_EOY", "LIAB_EOY", "FUNDBAL", "INITFEES", "GRRECPUB", "TXREVNUELEVIED170",
    "SRVCSVAL170", "GRSINC170", "TOTGFTGRNTRCVD509", "TXREVNUELEVIED509", "SRVCSVAL509",
    "SUBTOTSUPPINC509", "TOTSUPP509", "NETINC", "GOODS",
]
DROP_IF_EMPTY_FULL = [
    "PROGREV", "INVINC", "txexmptbndsproceeds", "royaltsinc", "grsrntsreal", "grsrntsprsnl",
    "rntlexpnsreal", "rntlexpnsprsnl", "rntlincreal", "rntlincprsnl", "NETRENT", "SECUR",
    "SALEOTHG", "SALESEXP", "SALEOTHE", "SALESECN", "SALEOTHN", "netgnls", "grsincfndrsng",
    "lessdirfndrsng", "netincfndrsng", "grsincgaming", "lessdirgaming", "netincgaming",
    "INVENTG", "GOODS", "GRPROF", "OTHINC", "TOTREV2", "COMPENS", "OTHSAL", "PAYTAX",
    "FUNDFEES", "EXPS", "ASS_EOY", "BOND_EOY", "MRTG_EOY", "unsecurednotesend", "LIAB_EOY",
    "RETEARN", "FUNDBAL", "INITFEES", "GRRECMEM", "GRRECOTH", "gftgrntsrcvd170",
    "txrevnuelevied170", "srvcsval170", "grsinc170", "grsrcptsrelated170", "totgftgrntrcvd509",
    "grsrcptsadmissn509", "txrevnuelevied509", "srvcsval509", "subtotsuppinc509", "totsupp509",
]
# ---------------------------------------------------------------------------

# ---------------------------------------------------------------------------
# PF crosswalk (release name, source name) and PF "drop if
# missing all of" list.
# ---------------------------------------------------------------------------
CROSSWALK_PF = [
    ("TAXPER", "tax_prd"), ("TAXPER", "tax_pd"), ("EOSTATUS", "eostatus"), ("STYEAR", "tax_yr"),
    ("RECCODE", "operatingcd"), ("P1TCONT", "grscontrgifts"), ("P1INTREV", "intrstrvnue"),
    ("P1DIVID", "dividndsamt"), ("P1GINVPF", "grsprofitbus"), ("P1OTHINC", "otherincamt"),
    ("P1OFCOMP", "compofficers"), ("P1CONTPD", "contrpdpbks"), ("P1TOTREV", "totrcptperbks"),
    ("P1TOTEXP", "totexpnspbks"), ("P1EXCREV", "excessrcpts"), ("P1TEXMEX", "totexpnsexempt"),
    ("P1NETINV", "netinvstinc"), ("P1NADINC", "adjnetinc"), ("P2TOTAST", "totassetsend"),
    ("P2GVTINV", "invstgovtoblig"), ("P2CRPSTK", "invstcorpstk"), ("P2CRPBND", "invstcorpbnd"),
    ("P2TINVSC", "totinvstsec"), ("P2TLIABL", "totliabend"), ("P2TASFMV", "fairmrktvaleoy"),
    ("P13UNDST", "undistribincyr"), ("P10MIR", "cmpmininvstret"), ("P6EXMPF", "sec4940notxcd"),
    ("P6DOMORG", "sec4940redtxcd"), ("P7POLIT", "infleg"), ("P7LIQUID", "contractncd"),
    ("P7POFCLM", "claimstatcd"), ("P7DISSAL", "propexchcd"), ("P7DISBOR", "brwlndmnycd"),
    ("P7DISSER", "furngoodscd"), ("P7DISPAY", "paidcmpncd"), ("P7DISTRA", "trnsothasstscd"),
    ("P7PAYGVT", "agremkpaycd"), ("P7UNDINC", "undistrinccd"), ("P7BUSINT", "dirindirintcd"),
    ("P7JEOINV", "invstjexmptcd"), ("P7PROPAG", "propgndacd"), ("P7ELECT", "excesshldcd"),
    ("P7INDGRT", "grntindivcd"), ("P7ORGGRT", "nchrtygrntcd"), ("P7OTHPUR", "nreligiouscd"),
    ("P1GRENTS", "grsrents"), ("P1GOODS", "costsold"), ("P1INVRV", "totrcptnetinc"),
    ("P1NADJRV", "trcptadjnetinc"), ("P1ADMEXP", "topradmnexpnsa"), ("P1INVEXP",
    "topradmnexpnsb"), ("P1CHAEXP", "topradmnexpnsd"), ("P1TINVEX", "totexpnsnetinc"),
    ("P1TADJEX", "totexpnsadjnet"), ("P2CASHBV", "othrcashamt"), ("P2MORTG", "mrtgloans"),
    ("P2EYOTIN", "othrinvstend"), ("P2EYASST", "fairmrktvalamt"), ("P2MTGNTS", "mrtgnotespay"),
    ("P3EYTFND", "tfundnworth"), ("P6TEXCTX", "totaxpyr"), ("P6TX511", "sect511tx"),
    ("P6TXSUBA", "subtitleatx"), ("P6ESTTX", "esttaxcr"), ("P6TXWTH", "txwithldsrc"),
    ("P6TXINV", "txpaidf2758"), ("P6TXWERR", "erronbkupwthld"), ("P6TXPNLT", "estpnlty"),
    ("P6TXCRDT", "crelamt"), ("P6TX4940", "invstexcisetx"), ("P10TASST", "tfairmrktunuse"),
    ("P11DISTR", "distribamt"), ("P14NADJA", "adjnetinccola"), ("P14NADJB", "adjnetinccolb"),
    ("P14NADJC", "adjnetinccolc"), ("P14NADJD", "adjnetinccold"), ("P14TNADJ", "adjnetinctot"),
    ("P14QDISA", "qlfydistriba"), ("P14QDISB", "qlfydistribb"), ("P14QDISC", "qlfydistribc"),
    ("P14QDISD", "qlfydistribd"), ("P14TQDIS", "qlfydistribtot"), ("P14ASVLA", "valassetscola"),
    ("P14ASVLB", "valassetscolb"), ("P14ASVLC", "valassetscolc"), ("P14ASVLD", "valassetscold"),
    ("P14TASVL", "valassetstot"), ("P14A4942", "qlfyasseta"), ("P14B4942", "qlfyassetb"),
    ("P14C4942", "qlfyassetc"), ("P14D4942", "qlfyassetd"), ("P14T4942", "qlfyassettot"),
    ("P14ENDWA", "endwmntscola"), ("P14ENDWB", "endwmntscolb"), ("P14ENDWC", "endwmntscolc"),
    ("P14ENDWD", "endwmntscold"), ("P14TENDW", "endwmntstot"), ("P14TSUPA", "totsuprtcola"),
    ("P14TSUPB", "totsuprtcolb"), ("P14TSUPC", "totsuprtcolc"), ("P14TSUPD", "totsuprtcold"),
    ("P14TTSUP", "totsuprttot"), ("P14PSUPA", "pubsuprtcola"), ("P14PSUPB", "pubsuprtcolb"),
    ("P14PSUPC", "pubsuprtcolc"), ("P14PSUPD", "pubsuprtcold"), ("P14TPSUP", "pubsuprttot"),
    ("P14GINVA", "grsinvstinca"), ("P14GINVB", "grsinvstincb"), ("P14GINVC", "grsinvstincc"),
    ("P14GINVD", "grsinvstincd"), ("P14TGINV", "grsinvstinctot"), ("SUBSECCD", "subcd"),
]
DROP_IF_EMPTY_PF = [
    "netinvstinc", "totaxpyr", "adjnetinc", "totassetsend", "invstgovtoblig", "invstcorpstk",
    "invstcorpbnd", "totinvstsec", "totliabend", "fairmrktvalamt", "undistribincyr",
    "cmpmininvstret", "sec4940notxcd", "sec4940redtxcd", "infleg", "contractncd", "claimstatcd",
    "propexchcd", "brwlndmnycd", "furngoodscd", "paidcmpncd", "trnsothasstscd", "agremkpaycd",
    "undistrinccd", "dirindirintcd", "invstjexmptcd", "propgndacd", "excesshldcd",
    "grntindivcd", "nchrtygrntcd", "nreligiouscd", "grsrents", "costsold", "totrcptnetinc",
    "trcptadjnetinc", "topradmnexpnsa", "topradmnexpnsb", "topradmnexpnsd", "totexpnsnetinc",
    "totexpnsadjnet", "othrcashamt", "mrtgloans", "othrinvstend", "fairmrktvaleoy",
    "mrtgnotespay", "tfundnworth", "invstexcisetx", "sect511tx", "subtitleatx", "esttaxcr",
    "txwithldsrc", "txpaidf2758", "erronbkupwthld", "estpnlty", "crelamt", "tfairmrktunuse",
    "distribamt", "adjnetinccola", "adjnetinccolb", "adjnetinccolc", "adjnetinccold",
    "adjnetinctot", "qlfydistriba", "qlfydistribb", "qlfydistribc", "qlfydistribd",
    "qlfydistribtot", "valassetscola", "valassetscolb", "valassetscolc", "valassetscold",
    "valassetstot", "qlfyasseta", "qlfyassetb", "qlfyassetc", "qlfyassetd", "qlfyassettot",
    "endwmntscola", "endwmntscolb", "endwmntscolc", "endwmntscold", "endwmntstot",
    "totsuprtcola", "totsuprtcolb", "totsuprtcolc", "totsuprtcold", "totsuprttot",
    "pubsuprtcola", "pubsuprtcolb", "pubsuprtcolc", "pubsuprtcold", "pubsuprttot",
    "grsinvstinca", "grsinvstincb", "grsinvstincc", "grsinvstincd", "grsinvstinctot",
]
# ---------------------------------------------------------------------------

# ---------------------------------------------------------------------------
# Amount columns made numeric after the read (B8), as listed
# (a few names repeat; repeats are harmless).
# ---------------------------------------------------------------------------
AMOUNT_COLUMNS = [
    "ACCNTINGFEES", "ACCNTSPAYABLEEND", "ACCNTSRCVBLEND", "ADVRTPROMO", "ASS_EOY",
    "BENIFITSMEMBRS", "BOND_EOY", "COMPENS", "COMPNSATNANDOTHR", "CONT", "CONVERCONVENTMTNG",
    "CURRFRMRCVBLEND", "DEFEREDREVNUEND", "DEPRCATNDEPLETN", "DIREXP", "DUESASSESMNTS",
    "ESCRWACCNTLIABEND", "EXPS", "FEESFORSRVCLOBBY", "FEESFORSRVCMGMT", "FEESFORSRVCINVSTMGMT",
    "FEESFORSRVCOTHR", "FISYR", "FUNDBAL", "FUNDFEES", "GOODS", "GRNSTTOINDIV",
    "GRNTSPAYABLEEND", "GRNTSTOFRGNGOVT", "GRNTSTOGOVT", "GRPROF", "GRSINCFNDRSNG",
    "GRSINCGAMING", "GRSRNTSPRSNL", "GRSRNTSREAL", "INFOTECH", "INSURANCE",
    "INTANGIBLEASSETSEND", "INTERESTAMT", "INVENTG", "INVINC", "INVNTRIESALESEND",
    "INVSTMNTSEND", "INVSTMNTSOTHREND", "INVSTMNTSPRGMEND", "LEGALFEES", "LESSDIRFNDRSNG",
    "LESSDIRGAMING", "LIAB_EOY", "LNDBLDGSEQUIPEND", "MISCREVTOTA", "MISCREVTOT11B",
    "MISCREVTOT11C", "MISCREVTOT11D", "MRTG_EOY", "NETGNLS", "NETINC", "NETINCFNDRSNG",
    "NETINCGAMING", "NETRENT", "NONINTCASHEND", "NOTESLOANSRCVBLEND", "OCCUPANCY", "OFFICEXPNS",
    "OTHINC", "OTHRASSETSEND", "OTHREMPLYEEBENEF", "OTHREXPNSA", "OTHREXPNSB", "OTHREXPNSC",
    "OTHREXPNSD", "OTHREXPNSE", "OTHREXPNSF", "OTHRLIABEND", "OTHSAL", "OVERPAY", "P1TOTEXP",
    "P1TOTREV", "P2TASFMV", "P2TOTAST", "P6ESTTX", "P6TEXCTX", "P6TXINV", "P6TXPNLT",
    "P6TXWERR", "P6TXWTH", "PAYBLETOFFCRSEND", "PAYTAX", "PENSIONPLANCONTRB",
    "PLDGEGRNTRCVBLEND", "PREPAIDEXPNSEND", "PRGMSERVREV", "PROGREV", "PYMTOAFFILIATES",
    "RCVBLDISQUALEND", "RNTLEXPNSPRSNL", "RNTLEXPNSREAL", "RNTLINCREAL", "RNTLINCPRSNL",
    "ROYALTSEXPNS", "ROYALTSINC", "SALEOTHE", "SALEOTHG", "SALEOTHN", "SALESECN", "SALESEXP",
    "STYEAR", "SVNGSTEMPINVEND", "TAXDUE", "TOTEXCAPGN", "TOTEXCAPLS", "TOTNETLIABASTEND",
    "TOTREV", "TOTREV2", "TOTREV2ACOLA", "TOTREV2BCOLA", "TOTREV2CCOLA", "TOTREV2DCOLA",
    "TOTREV2ECOLA", "TOTREV2FCOLA", "TRAVEL", "TRAVELOFPUBLICOFFCL", "TXEXMPTBNDSPROCEEDS",
    "UNSECUREDNOTESEND", "P1TOTREV", "P1TCONT", "P1INTREV", "P1DIVID", "P1GRENTS", "P1NGASTS",
    "P1GINVPF", "P1OTHINC", "P1TOTEXP", "P1ADMEXP", "P1CONTPD", "P1EXCREV", "P1TOTREV",
    "P1TOTEXP", "P14TNADJ", "P14NADJA", "P14NADJB", "P14NADJC", "P14NADJD", "P14TQDIS",
    "P14QDISA", "P14QDISB", "P14QDISC", "P14QDISD", "P14TASVL", "P14ASVLA", "P14ASVLB",
    "P14ASVLC", "P14ASVLD", "P14T4942", "P14A4942", "P14B4942", "P14C4942", "P14D4942",
    "P14TENDW", "P14ENDWA", "P14ENDWB", "P14ENDWC", "P14ENDWD", "P14TTSUP", "P14TSUPA",
    "P14TSUPB", "P14TSUPC", "P14TSUPD", "P14TPSUP", "P14PSUPA", "P14PSUPB", "P14PSUPC",
    "P14PSUPD", "P14TGINV", "P14GINVA", "P14GINVB", "P14GINVC", "P14GINVD", "P2TINVSC",
    "P2GVTINV", "P2CRPSTK", "P2CRPBND", "TOTREVP", "EXPSP", "ASS_BOY",
]
# ---------------------------------------------------------------------------

CROSSWALKS = {"EZ": CROSSWALK_EZ, "FULL": CROSSWALK_FULL, "PF": CROSSWALK_PF}
DROP_LISTS = {"EZ": DROP_IF_EMPTY_EZ, "FULL": DROP_IF_EMPTY_FULL, "PF": DROP_IF_EMPTY_PF}


def read_pairs(path: str, skip_header: bool = True) -> list[tuple[str, str]]:
    """A crosswalk file: ``RELEASE,SOURCE`` per line (small config file)."""
    with open(path) as f:
        lines = [ln.strip() for ln in f if ln.strip()]
    lines = lines[1:] if skip_header else lines
    return [tuple(x.strip() for x in ln.split(",", 1)) for ln in lines]


def read_names(path: str, skip_header: bool = False) -> list[str]:
    """A one-column list file (drop list or final column list)."""
    with open(path) as f:
        lines = [ln.rstrip("\n").strip() for ln in f]
    lines = lines[1:] if skip_header else lines
    return [ln for ln in lines if ln]
