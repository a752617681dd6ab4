"""Fixed values of the legal domain: names, codes, markers and patterns that results depend on."""

from __future__ import annotations

# Courts and their codes.
COURTS = {
    "憲法法庭": "JCC",
    "司法院刑事補償法庭": "TPC",
    "最高法院": "TPS",
    "最高行政法院": "TPA",
    "懲戒法院": "TPP",
    "懲戒法院懲戒法庭": "TPPD",
    "懲戒法院職務法庭": "TPJ",
    "智慧財產及商業法院": "IPC",
    "臺灣高等法院": "TPH",
    "臺灣高等法院臺中分院": "TCH",
    "臺灣高等法院臺南分院": "TNH",
    "臺灣高等法院高雄分院": "KSH",
    "臺灣高等法院花蓮分院": "HLH",
    "福建高等法院金門分院": "KMH",
    "臺北高等行政法院": "TPB",
    "臺中高等行政法院": "TCB",
    "高雄高等行政法院": "KSB",
    "臺灣臺北地方法院": "TPD",
    "臺灣士林地方法院": "SLD",
    "臺灣新北地方法院": "PCD",
    "臺灣宜蘭地方法院": "ILD",
    "臺灣基隆地方法院": "KLD",
    "臺灣桃園地方法院": "TYD",
    "臺灣新竹地方法院": "SCD",
    "臺灣苗栗地方法院": "MLD",
    "臺灣臺中地方法院": "TCD",
    "臺灣彰化地方法院": "CHD",
    "臺灣南投地方法院": "NTD",
    "臺灣雲林地方法院": "ULD",
    "臺灣嘉義地方法院": "CYD",
    "臺灣臺南地方法院": "TND",
    "臺灣高雄地方法院": "KSD",
    "臺灣橋頭地方法院": "CTD",
    "臺灣花蓮地方法院": "HLD",
    "臺灣臺東地方法院": "TTD",
    "臺灣屏東地方法院": "PTD",
    "臺灣澎湖地方法院": "PHD",
    "福建金門地方法院": "KMD",
    "福建連江地方法院": "LCD",
    "臺灣高雄少年及家事法院": "KSY",
}
# Levels of courts (1 is the highest); all others have DEFAULT_LEVEL.
COURT_LEVELS = {"JCC": 1, "TPS": 1, "TPA": 1, "TPH": 2, "TCH": 2, "TNH": 2, "KSH": 2, "HLH": 2, "KMH": 2, "TPB": 2, "TCB": 2, "KSB": 2, "IPC": 2, "TPP": 2, "TPPD": 2, "TPJ": 2, "TPC": 2}
DEFAULT_LEVEL, MISSING_LEVEL = 3, 99
# Case types and their codes; the default fan-out leaves the last one out.
CASE_TYPES = {"民事": "V", "刑事": "M", "行政": "A", "懲戒": "P"}
FAN_OUT = ("V", "M", "A")

# Short forms of law names.
ALIASES = {
    "消保法": "消費者保護法",
    "勞基法": "勞動基準法",
    "個資法": "個人資料保護法",
    "國賠法": "國家賠償法",
    "道交條例": "道路交通管理處罰條例",
    "證交法": "證券交易法",
    "公交法": "公平交易法",
    "強執法": "強制執行法",
    "家事法": "家事事件法",
    "少事法": "少年事件處理法",
    "社維法": "社會秩序維護法",
    "行程法": "行政程序法",
    "民訴法": "民事訴訟法",
    "刑訴法": "刑事訴訟法",
    "行訴法": "行政訴訟法",
    "不經條例": "不動產經紀業管理條例",
    "智財法": "智慧財產案件審理法",
    "稅徵法": "稅捐稽徵法",
    "政採法": "政府採購法",
    "遺贈稅法": "遺產及贈與稅法",
    "公寓條例": "公寓大廈管理條例",
    "大廈條例": "公寓大廈管理條例",
    "營業稅法": "加值型及非加值型營業稅法",
    "刑法": "中華民國刑法",
}
# Law names and codes to fall back on without a dictionary.
BUILTIN_LAWS = {
    "民法": "B0000001",
    "民事訴訟法": "B0010001",
    "刑法": "C0000001",
    "刑事訴訟法": "C0010001",
    "勞動基準法": "N0030001",
    "消費者保護法": "J0170001",
    "公平交易法": "J0150002",
    "個人資料保護法": "I0050021",
    "公司法": "J0080001",
    "強制執行法": "B0010004",
    "行政訴訟法": "A0030154",
    "訴願法": "A0030020",
    "國家賠償法": "I0020004",
    "著作權法": "J0070017",
    "專利法": "J0070007",
    "商標法": "J0070001",
    "營業秘密法": "J0080028",
    "保險法": "G0390002",
    "證券交易法": "G0400001",
    "銀行法": "G0380001",
    "勞工退休金條例": "N0030020",
    "性別平等工作法": "N0030014",
    "智慧財產案件審理法": "A0030215",
    "商業事件審理法": "B0010071",
    "土地法": "D0060001",
    "租賃住宅市場發展及管理條例": "D0060125",
    "行政程序法": "A0030055",
    "行政罰法": "A0030210",
    "政府採購法": "A0030057",
    "中華民國憲法": "A0000001",
    "憲法訴訟法": "A0030159",
    "家事事件法": "B0010048",
    "仲裁法": "I0020001",
    "鄉鎮市調解條例": "I0020003",
    "勞動事件法": "B0010064",
    "國民法官法": "A0030320",
    "洗錢防制法": "G0380131",
    "稅捐稽徵法": "G0340001",
    "所得稅法": "G0340003",
    "營業稅法": "G0340080",
    "票據法": "G0380028",
    "海商法": "K0070002",
    "破產法": "B0010006",
    "信託法": "I0020024",
    "民法總則施行法": "B0000002",
    "民法債編施行法": "B0000003",
    "民法物權編施行法": "B0000004",
    "民法親屬編施行法": "B0000005",
    "民法繼承編施行法": "B0000006",
    "涉外民事法律適用法": "B0000007",
    "建築法": "D0070109",
    "公寓大廈管理條例": "D0070118",
    "不動產經紀業管理條例": "D0060066",
    "道路交通管理處罰條例": "K0040012",
    "少年事件處理法": "C0010011",
    "社會秩序維護法": "D0080067",
    "遺產及贈與稅法": "G0340072",
}
# Short names that texts use besides the dictionary's.
SHORT_NAMES = ["刑法", "憲法", "營業稅法", "勞基法", "消保法", "個資法", "國賠法", "道交條例"]
# What may stand before a law's name, in the order of testing.
NAME_PREFIXES = [
    "依", "按", "照", "據", "參", "援", "適用", "準用", "違反", "以及", "及", "與", "或", "和", "又", "暨",
    "另依", "再依", "得依", "應依", "得按", "應按", "得適用", "應適用",
]
# Law names that the statute pattern tries in this order before its general form.
PATTERN_NAMES = [
    "民事訴訟法施行法", "刑事訴訟法施行法", "民事訴訟法", "刑事訴訟法", "行政訴訟法", "行政程序法", "消費者保護法", "個人資料保護法",
    "不動產經紀業管理條例", "道路交通管理處罰條例", "智慧財產案件審理法", "遺產及贈與稅法", "少年事件處理法", "社會秩序維護法",
    "金融消費者保護法", "期貨交易法", "勞動基準法", "勞動事件法", "家事事件法", "證券交易法", "公平交易法", "強制執行法", "政府採購法",
    "稅捐稽徵法", "國家賠償法", "著作權法", "營業秘密法", "公寓大廈管理條例", "土地登記規則", "商業事件審理法", "國民法官法",
    "洗錢防制法", "信託法", "仲裁法", "破產法", "民法", "刑法", "憲法", "公司法", "土地法", "專利法", "商標法", "保險法", "海商法",
    "票據法", "所得稅法", "營業稅法", "銀行法", "建築法",
]
# Page titles that are no law names, and texts of page footers.
INVALID_NAMES = ["條文內容", "法規內容", "全國法規資料庫", "歷史法規", ""]
BOILERPLATE = [
    "本網站係提供法規之最新動態資訊", "若有任何法律上的疑義", "著作權聲明", "隱私權保護", "網站安全政策", "瀏覽人次總計",
    "法規整編資料截止日", "本站所提供資料僅供參考", "電子報訂閱",
]
# Roles of parties, headings of sections, words that end or don't belong to the list of parties.
ROLES = ["共同", "上訴人", "被上訴人", "原告", "被告", "抗告人", "相對人", "聲請人", "再抗告人", "再審原告", "再審被告", "法定代理人", "訴訟代理人"]
FACTS_HEADINGS = ["事實", "事實及理由", "事實與理由", "犯罪事實", "犯罪事實及理由"]
PARTY_STOPS = ["上列", "當事人間", "提起", "本院"]
PARTY_FILLERS = ["共同", "兼", "即", "即被告"]
NOT_NAMES = ["年度", "字第", "判決", "裁定", "事件"]
# Fields that a page of a ruling must have, by system.
CRITICAL_FIELDS = {"釋字": ["解釋字號", "解釋文"], "憲判字": ["判決字號", "主文", "理由"]}
MIN_FIELDS = 3
# Hosts that documents may come from.
ALLOWED_HOSTS = ["judgment.judicial.gov.tw", "data.judicial.gov.tw", "law.moj.gov.tw"]

# Fixed value: the end of a text that was cut; its length and what is missing go in.
CUT_WARNING = (
    "\n\n[System Warning: 本欄位字數過長（原長 %d 字），已截斷末端 %d 字。請優先基於已提供的部分進行推理，切勿直接斷言「大法官並未提及某事」"
    "——被截斷的內容可能包含關鍵論述。若判斷末端內容關鍵，可回報使用者需人工查閱完整判決。]"
)
# What a page that refuses the visitor says if it is shorter than REFUSAL_CHARS, and what a challenge page holds.
REFUSAL, REFUSAL_CHARS, CHALLENGE = "Request Rejected", 500, ["bobcmn", "TSPD"]
# Limits.
PAGE_SIZE = 50
MAX_RESULTS = 200
SAFETY_VALVE = 15_000
SNIPPET_CONTEXT, SNIPPET_MATCHES, CITATION_CONTEXT = 200, 10, 80
SUBSTANTIVE = 50
MIN_DICTIONARY = 10_000
TTL_SECONDS = {"judgment": 2_592_000, "search": 86_400, "regulation": 604_800}

# Grammars of identifiers.
JID = r"^[A-Z]{2,6},[0-9]+,[^,]+,[0-9A-Za-z\-]+,[0-9]{8},[0-9]+$"
OLD_CITATION = r"釋字第\s*(\d+)\s*號"
NEW_CITATION = r"(\d{3,4})\s*年\s*憲判字第\s*(\d+)\s*號"
CASE_ID = r"(?U)\d+\s*年度?\s*.*字\s*第?\s*\d+\s*號"
_BRANCH = r"(?:\S{2,3}分院)?"


def court_pattern(island: str) -> str:
    """Names of courts; island: how the name of the island is written."""
    kinds = [
        r"最高(?:行政)?法院", r"(?:臺北|臺中|高雄)高等行政法院", rf"{island}高等法院{_BRANCH}", rf"{island}\S+?(?:地方|少年及家事)法院", r"智慧財產(?:及商業)?法院", r"懲戒法院",
        rf"福建\S*?(?:地方|高等)法院{_BRANCH}",
    ]
    return f"(?:{'|'.join(kinds)})"


COURT, CITED_COURT = f"({court_pattern('臺灣')})", court_pattern("(?:臺灣|台灣)")
ROC_DATE_LINE = r"中\s*華\s*民\s*國\s*(\d{2,3})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日"
JUDGE = r"(?:審判長)?法\s*官\s+(.+?)$"
CAUSE = r"(?:間|因)(?:請求)?(.{2,20}?)事件"
CN_DIGITS = "[一二三四五六七八九十百千零〇０]"

CURRENT, ABOLISHED = "現行法規", "已廢止"
