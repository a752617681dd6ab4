"""Invented rows for what the generated tables don't have: laws, judgments, rulings."""

from __future__ import annotations

from .base import Fixture

LAWS = Fixture("ordinal bigint, law_name string, pcode string, abolished boolean", [
    (0, "民法", "B0000001", False), (1, "中華民國刑法", "C0000001", False), (2, "民事訴訟法", "B0010001", False), (3, "勞動基準法", "N0030001", False),
    (4, "勞動基準法施行細則", "N0030002", False), (5, "消費者保護法", "J0170001", False), (6, "全民健康保險法", "L0060001", False), (7, "保險法", "G0390002", False),
    (8, "公司法", "J0080001", False), (9, "洗錢防制法", "G0380131", False), (10, "工廠法", "A0000005", True), (11, "礦場法", "A0000006", True),
    (12, "舊道路交通法", "K0000009", True), (13, "道路交通管理處罰條例", "K0040012", False), (14, "道路交通法", "K0000009", True), (15, "公平交易法", "J0150002", False),
])
TERMS = Fixture("term string", [(t,) for t in ["民法", "保險法", "勞基法", "消保法", "證交法", "仲裁法", "民法第184條", "消費者保護法施行細則", "健康保險", "交通", "無此名稱", "勞動", "刑法", "道交條例"]])
CODES = Fixture("pcode string, parsed_name string", [("B0000001", ""), ("K0000009", "x"), ("I0020001", ""), ("X1", "某辦法"), ("X2", "條文內容"), ("X3", "")])
ARTICLES = Fixture("pcode string, number string, content string", [
    ("B0000001", n, f"第 {n} 條之內容。") for n in ["14", "15", "15-1", "15-2", "15-10", "16", "247", "247-1", "247-12", "9之2", "附則", "", "16.5"]
] + [("G0390002", "1", "保險之定義。"), ("A0000005", "1", "本法稱工廠。")])
HISTORIES = Fixture("pcode string, history string", [("B0000001", "中華民國十八年公布"), ("Z9", "無")])
JIDS = Fixture("ordinal bigint, jid string", list(enumerate([
    "TPSV,104,台上,472,20150326,1", "TPPDP,109,清,12,20200203,1", "TPPP,108,澄,3,20190101,1", "TPDM,110,訴,99,20210909,2", "KSYV,111,家,7,20220101,1", "IPCA,112,行商訴,5,20230505,1",
    "XXXV,104,台上,472,20150326,1", "TPHX,104,上,472,20150326,1", "bad", "", "TCDV,104,訴,1,20150326", None,
])))
RESULTS = Fixture("arrival bigint, jid string, court string, court_level int, case_type string, year int, word string, number string, full_text string, main_text string", [
    (0, "TPDV,110,訴,1,20210101,1", "臺灣臺北地方法院", 3, "民事", 110, "訴", "1", "給付 價金 事件", "被告應將房屋移轉"), (1, "TPSV,109,台上,5,20200101,1", "最高法院", 1, "民事", 109, "台上", "5", "請求移轉登記", "上訴駁回"),
    (2, "TPHM,111,上,7,20220101,1", "臺灣高等法院", 2, "刑事", 111, "上", "7", "價金詐欺", "原判決撤銷"), (3, "TPSV,109,台上,5,20200101,1", "最高法院", 1, "民事", 109, "台上", "5", "請求移轉登記", "上訴駁回"),
    (4, "TPSM,109,臺上,5,20200101,2", "最高法院", 1, "刑事", 109, "臺上", "5", "價金 給付", "上訴駁回"), (5, "TPPP,109,台上,5,20200101,1", "懲戒法院", 2, "懲戒", 109, "台上", "5", "懲戒價金", "申誡"),
    (6, "TCDV,108,訴,9,20190101,1", "臺灣臺中地方法院", 3, "民事", 108, "訴", "9", "給付 價金", "被告應給付"), (7, "", "最高法院", 1, "民事", 109, "台上", "5", "價金", "無"),
])
LONG = "本院認為人民之權利應受保障。" * 1200
RULINGS = Fixture("system string, year bigint, number bigint, issues string, reasoning string, opinions string", [
    ("釋字", 0, 1, "立法委員得兼官吏？", "短文", "釋字第1號解釋_OCR"), ("釋字", 0, 499, "修憲界限", "參照本院釋字第 3 號及釋字第1號解釋，又釋字第１號。" + "理由甚多。" * 20, None),
    ("釋字", 0, 748, "同性二人婚姻自由案", "本院釋字第 499 號、釋字第242號、111年憲判字第1號與釋字第242號解釋參照；第748號解釋不計。" + "婚姻自由受憲法保障。" * 30, "協同意見書" * 20),
    ("憲判字", 111, 1, "肇事逃逸強制抽血案", "釋字第 748 號解釋及 111 年憲判字第 2 號判決意旨；" + "抽血應經令狀。" * 40, "不同意見" * 30), ("憲判字", 111, 2, "強制道歉案", LONG, None), ("憲判字", 112, 1, None, None, None),
])
CASE_REFS = Fixture("ordinal bigint, raw string", list(enumerate([
    "釋字第 748 號", "釋字748", "司法院釋字第499號解釋", "88 年釋字第 499 號", "111年憲判字第1號", "111憲判1", " 111憲判字第2號 ", "憲判字第1號", "111年憲判", "748", " 12 ", "釋字", "abc", "", None, "解釋第7號",
])))
NUMERALS = Fixture("numeral string, value bigint", [
    ("三", 3), ("十", 10), ("十八", 18), ("二十", 20), ("三百七十七", 377), ("一千零一", 1001), ("九百九十九", 999), ("一百零五", 105), ("九千九百九十九", 9999), ("百", 0), ("千", 0), ("二三", 3), ("〇", 0), ("", 0), ("一百十", 110),
])
STATUTE_TEXTS = Fixture("doc_id bigint, text string", list(enumerate([
    "依民法第三百七十七條之規定", "勞動基準法第十八條之一", "民法第247-1條及民法第247之1條", "", "按刑法第 339 條第 1 項、違反洗錢防制法第十四條", "適用民事訴訟法第二百五十五條，又民法第一百八十四條、民法第184條", "公司法第百條不計", None, "消費者保護法第7條、消費者保護法第7條",
])))
JUDGMENT = """版面大小 120% 100% 80%
臺灣臺北地方法院民事判決
110年度訴字第123號
原　　　告  王　大　明
            李  小  華
訴訟代理人  陳律師
被　　　告  某某股份有限公司
法定代理人  張  三
上列當事人間請求給付價金事件，本院於中華民國110年1月5日言詞辯論終結，判決如下：
　　主　文
被告應給付原告新臺幣壹佰元。
訴訟費用由被告負擔。
　　事實及理由
一、原告主張：依民法第三百六十七條及最高法院 109 年度台上字第 5 號判決。


二、被告則以：中華民國109年12月1日已清償。
　　理　由
本院之判斷：民法第184條參照，臺灣高等法院臺中分院98年度上字第77號同旨。
中　　華　　民　　國　  110　 年　  1 　 月　 　20　 日
              民事第一庭  審判長法　官  林　　甲
                                法　官  陳　　乙   
以上正本係照原本作成。
中　　華　　民　　國　 110　年　1　月　21　日
                                書記官  吳丙"""
JUDGMENTS = Fixture("jid string, raw_text string", [("TPDV,110,訴,123,20210120,1", JUDGMENT), ("TPSV,109,台上,5,20200101,1", "最高法院民事裁定\n109年度台上字第5號\n主文\n上訴駁回。"), ("X", ""), ("Y", None)])
RESULT_PAGE = """<html><body><table id="jud" class="jub-table"><tr><th>序號</th><th>裁判字號</th><th>日期</th><th>案由</th></tr>
<tr><td>1.</td><td><a class="hlTitle_scroll" href="data.aspx?ty=JD&amp;id=TPSV%2c104%2c%e5%8f%b0%e4%b8%8a%2c472%2c20150326%2c1">最高法院 104 年度台上字第 472 號判決</a></td><td>104.03.26</td><td>給付價金</td></tr>
<tr class="summary"><td colspan="4"><span class="tdCut"> 要旨一 </span></td></tr>
<tr><td>2.</td><td><a href="https://judgment.judicial.gov.tw/FJUD/data.aspx?ty=JD&id=TPPDP,109,x,12,20200203,1">懲戒法院</a></td><td>109/2/3</td></tr>
<tr><td>short</td></tr><tr><td>3.</td><td>沒有連結</td><td>109.1.1</td><td>x</td></tr></table></body></html>"""
STATUTE_PAGE = """<html><head><title>民法-全國法規資料庫</title></head><body><h2>民法-全國法規資料庫</h2><div class="law-reg-content">
<div class="h3 char-1">第 一 編 總則</div><div class="h3 char-2">第 一 章 法例</div>
<div class="row"><div class="col-no">第 1 條</div><div class="col-data">民事，法律所未規定者，依習慣。</div></div>
<div class="row"><div class="col-no">第 1-1 條</div><div class="col-data">增訂。</div></div>
<div class="h3 char-3">第 二 節 尾</div><div class="row"><div class="col-no">無號</div><div class="col-data">略</div></div></div></body></html>"""
RULING_PAGE = """<ul><li class="title">解釋字號</li><li class="text">釋字第748號</li></ul><ul><li class="title">解釋文</li><li class="text"><ul class="paragraphs"><li><pre>第一段</pre></li><li><pre>第二段</pre></li></ul></li></ul>
<ul><li class="title">解釋文</li><li class="text">重複</li></ul><ul><li class="title">理由書</li><li class="text">理由<br>續</li></ul>"""
LISTING = """<a title="釋字第748號" href="/docdata.aspx?fid=100&amp;id=310929">x</a><a title="釋字第1號" href="/docdata.aspx?fid=100&id=310001">x</a>
<a href="/docdata.aspx?fid=38&amp;id=309000" class="t" title="111年憲判字第1號">x</a>"""
PAGES = Fixture("page_id string, html string", [("results", RESULT_PAGE), ("statute", STATUTE_PAGE), ("ruling", RULING_PAGE), ("listing", LISTING), ("judgment", f'<div id="jud"><div class="row"><div class="col-th">裁判案由：</div><div class="col-td">給付價金</div></div><div class="htmlcontent">{"內文" * 30}<abbr class="t">不確定故意</abbr>者</div></div>'), ("empty", "")])
URLS = Fixture("url string", [(u,) for u in [
    "https://judgment.judicial.gov.tw/FJUD/data.aspx?ty=JD&id=TPSV%2c104%2c%e5%8f%b0%e4%b8%8a%2c472%2c20150326%2c1", "http://data.judicial.gov.tw/x", "https://law.moj.gov.tw/LawClass/LawAll.aspx?pcode=B0000001", "https://law.moj.gov.tw/LawClass/LawAll.aspx?x=1&PCode=B0000002",
    "https://evil.com/law.moj.gov.tw", "https://law.moj.gov.tw.evil.com/", "http://169.254.169.254/latest", "file:///etc/passwd", "ftp://judgment.judicial.gov.tw/", "gopher://law.moj.gov.tw/", "javascript:alert(1)", "https://user@law.moj.gov.tw:443/a", "",
]])
