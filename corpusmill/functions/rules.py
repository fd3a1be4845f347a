"""Default rule lists. They must equal the rules of the pipelines that users run today; every operator takes its own as a parameter."""

TRACKING_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "spm", "from", "ref", "fromtimestamp")
TITLE_NOISE = r"[\s　\(\)（）\[\]【】《》\"'：:;；,，.。!！?？\-—_]+"
NUMBER_NOISE = r"[\s\(\)（）\[\]【】〔〕年号]+"

DOMAIN_BLACKLIST = (
    "xinhuanet.com", "people.com.cn", "cctv.com", "thepaper.cn",
    "sohu.com", "sina.com.cn", "163.com", "qq.com", "ifeng.com",
    "escn.com.cn", "in-en.com", "bjx.com.cn",
    "credit.sh.gov.cn", "credit.beijing.gov.cn",
)
#: Rejected without a look at the title: all of them but those of authorities.
FAST_REJECT_DOMAINS = tuple(d for d in DOMAIN_BLACKLIST if not d.endswith(".gov.cn"))
GOV_SUFFIXES = (".gov.cn", ".org.cn")
TITLE_BAD_PATTERNS = (r"_市县$", r"^\[\w+网\]", r"国际\w{1,4}网")
NON_POLICY_TITLE_MARKERS = (
    "中标公告", "中标结果", "中标候选", "成交公告", "招标公告", "采购公告",
    "询价公告", "竞争性磋商", "竞争性谈判", "单一来源", "中选公告",
    "废标公告", "流标公告", "资格预审", "比选公告",
    "新闻发布会", "例行新闻发布", "白皮书", "蓝皮书",
    "大学习", "大讨论", "大提升", "主题党日", "党史学习教育",
    "表彰大会", "誓师大会", "文艺汇演", "演讲比赛",
)
NON_POLICY_TITLE_PATTERNS = (r"发布.{0,40}报告[》(（]",)
BOX_DRAWING = r"[─-╿]"
GOV_ISSUER_KEYWORDS = ("委", "局", "部", "院", "司", "厅", "办公厅", "政府", "国务院", "管理委员会", "管委会")
POLICY_TITLE_SIGNALS = ("通知", "意见", "规定", "办法", "方案", "决定", "批复", "措施", "规划", "细则", "标准", "条例", "暂行", "导则")
COMMENTARY_MARKERS = ("政策解读", "解读材料", "文字解读", "答记者问", "一图读懂", "图解", "图读", "问答")
REVIEW_THRESHOLD = 0.7

#: (pattern, reason), the first that hits counts.
SKIP_PATTERNS = (
    (r"招聘|诚聘|岗位招募|招募", "招聘"),
    (r"节快乐|放假通知|假期安排|祝.{0,4}节", "节日"),
    (r"^视频[：:]|^\s*视频\s*[:：]", "纯视频"),
    (r"活动征集|报名通道|诚邀参加|征集启事", "活动通知"),
)
CAPACITY = r"(?i)\d+\s*(MW|GW|GWh|MWh)"
PROCUREMENT = r"中标|开标|采购公告|招标公告|招标|EPC|中标公示|开标公示"
MARKET_PATTERNS = (
    (r"采购公告|招标公告|中标公示|开标公示", "采购招标公示"),
    (r"IPO|过会|拟上市|挂牌上市|完成.{0,8}(融资|募资)|获.{0,6}轮.{0,4}融资|募资|定增", "资本市场动态"),
    (r"出货.{0,8}(GWh|GW|万|亿)|同比增长.*%", "出货/增速数据"),
)

BASIS_KEYWORDS = ("根据", "依据", "贯彻", "落实", "按照", "结合实际", "结合本")
SUPERSEDES_KEYWORDS = ("同时废止", "同步废止", "即行废止", "废止", "停止执行", "失效")
SUPERSEDES_NEAR = ("即行废止", "同时废止", "同步废止")
CLARIFIES_KEYWORDS = ("实施细则", "操作指引", "申报指南", "办事指南", "解读", "细则")
RELATION_CONFIDENCE = {"references": 0.72, "cites_basis": 0.9, "supersedes": 0.95, "clarifies": 0.86}
HIGH_PRECISION_RELATIONS = ("references", "cites_basis", "supersedes", "clarifies")
SEMANTIC_RELATIONS = ("iterates", "extends", "derives_from", "aligns_with")
REGION_RANK = {"国": 3, "省": 2, "市": 1, "区": 0, "县": 0}
EXTEND_WORDS = ("扩大", "扩围", "推广", "全面实施", "由试点", "适用范围", "新增")
WINDOW_ANCHORS = ("为贯彻", "为落实", "根据", "依据", "贯彻", "落实", "按照", "结合", "扩大", "扩围", "推广", "全面实施", "由试点")

#: role -> keywords; roles and keywords are tried in this order.
ROLE_KEYWORDS = {
    "risk": ("风险", "不确定", "压力", "亏损", "下调", "受限", "冲击", "挑战", "瓶颈", "阻力", "担忧", "短期难"),
    "opportunity": ("机会", "利好", "增长", "空间", "补贴", "收益", "商业模式", "需求", "优势", "窗口"),
    "execution": ("落地", "执行", "推进", "试点", "建设", "项目", "招标", "并网", "实施", "配置", "运行"),
    "attention": ("关注", "热议", "看点", "解读", "问答", "一图读懂", "研讨", "观察"),
}
SIGNAL_KEYWORDS = {
    "capacity_disclosure": ("可开放容量", "容量表", "开放容量"),
    "price_signal": ("价格调整", "调价", "汽、柴油价格", "柴油价格", "汽油价格"),
    "subsidy_list": ("补贴清单", "奖补", "补贴"),
    "trading_result": ("交易", "成交", "挂牌"),
    "tender_procurement": ("招标", "采购", "公开遴选", "设计-采购", "EPC"),
    "competitive_allocation": ("竞配", "竞争性配置", "评分结果", "回收指标"),
    "project_list": ("项目清单", "清单公示"),
    "pilot_landing": ("试点", "落地", "示范", "投运", "首个"),
    "project_commissioned": ("并网", "建成", "投产", "上线", "全容量"),
    "market_access": ("许可", "批准证书", "经营网点"),
    "project_progress": ("推进", "调度", "座谈", "进展"),
    "project_case": ("典型案例", "入选"),
}
BUSINESS_LINES = {
    "charging_infra": ("charging",), "residential_charging": ("charging",), "v2g": ("charging", "power"), "vpp_theme": ("power",),
    "aggregator_access": ("power",), "power_market": ("power",), "energy_storage_theme": ("power",), "green_power_trading_theme": ("power",),
    "distribution_grid_opening": ("power",), "carbon_market_theme": ("power",), "gas_station_transition_theme": ("fuel",), "petroleum_retail_compliance": ("fuel",),
}
OPPORTUNITY_THEMES = ("power_market", "vpp_theme", "v2g", "green_power_trading_theme", "energy_storage_theme", "aggregator_access", "distribution_grid_opening", "equipment_renewal_theme")
COMPLIANCE_THEMES = ("petroleum_retail_compliance", "carbon_market_theme")
MOAT_THEMES = ("residential_charging", "charging_infra", "gas_station_transition_theme")

ISSUER_SHORT = {
    "国家发展和改革委员会": "NDRC", "国家能源局": "NEA", "工业和信息化部": "MIIT", "商务部": "MOFCOM",
    "住房和城乡建设部": "MOHURD", "生态环境部": "MEE", "财政部": "MOF", "国务院": "SC",
}
ISSUER_BY_HOST = {
    "www.gov.cn": "国务院", "www.ndrc.gov.cn": "国家发展和改革委员会", "www.nea.gov.cn": "国家能源局", "www.miit.gov.cn": "工业和信息化部",
    "www.mofcom.gov.cn": "商务部", "www.mohurd.gov.cn": "住房和城乡建设部", "www.mee.gov.cn": "生态环境部", "www.mof.gov.cn": "财政部",
}
PROVINCE_SHORT = {
    "11": "BJ", "12": "TJ", "13": "HE", "14": "SX", "15": "NM", "21": "LN", "22": "JL", "23": "HL",
    "31": "SH", "32": "JS", "33": "ZJ", "34": "AH", "35": "FJ", "36": "JX", "37": "SD",
    "41": "HA", "42": "HB", "43": "HN", "44": "GD", "45": "GX", "46": "HI",
    "50": "CQ", "51": "SC", "52": "GZ", "53": "YN", "54": "XZ",
    "61": "SN", "62": "GS", "63": "QH", "64": "NX", "65": "XJ", "71": "TW", "81": "HK", "82": "MO",
}
CHANNEL_SHORT = {"发改委": "FGW", "能源局": "NYJ", "政府网": "GOV", "经信委": "JXW", "商务局": "SWJ"}
DIRECT_CITIES = ("110000", "120000", "310000", "500000")

CN_DIGITS = "〇○零一二三四五六七八九"
CN_DIGIT_VALUES = "000123456789"
EFFECTIVE_AFTER = r"^\s*起?(?:施行|执行|生效|实施)"
DEADLINE_BEFORE = r"(?:有效期至|有效期到|截止|截至)\s*$"
ORG_BEFORE = r"(?:委员会|管委会|发展改革委|能源局|办公厅|办公室|人民政府|政府|管理局|监管办|委|局|厅|部|院)[\s　]*$"
ISSUANCE_LABEL = r"(?:发布日期|成文日期|印发日期|发文日期|日期\s*[:：])\s*$"
