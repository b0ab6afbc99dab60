"""Keyword tier: ordered title patterns, matched over lower-cased titles.

Fixed values. The order is the priority: the first matching row decides.
"""

ROLE = [
    ("Data Scientist", r"data scien"),
    ("Data Engineer", r"(data engineer|\betl\b|big data)"),
    ("Machine Learning Engineer", r"(machine learning|ml engineer|ai engineer|deep learning)"),
    ("Cybersecurity Specialist", r"(cybersecur|information security|security engineer|security analyst|infosec|penetration|soc analyst)"),
    ("DevOps Engineer", r"(devops|\bsre\b|site reliability|platform engineer)"),
    ("QA Engineer", r"(\bqa\b|quality assurance|test engineer|\btester\b|\bsdet\b)"),
    ("IT Specialist", r"(it support|help desk|service desk|desktop support|sysadmin|system administrator|network engineer|information technology|it specialist|it technician)"),
    ("Healthcare Professional", r"(nurse|nursing|\brn\b|\blpn\b|\bcna\b|physician|surgeon|\bdoctor\b|dentist|dental|hygienist|therapist|respiratory|pharmac|veterinar|paramedic|\bemt\b|phleboto|radiolog|caregiv|hospice|midwif|medical|clinician|clinical|patient care)"),
    ("Legal Professional", r"(attorney|lawyer|paralegal|litigation|\bcounsel\b|law clerk|legal)"),
    ("Teacher & Educator", r"(teacher|professor|lecturer|tutor|instructor|educat|faculty|adjunct|childcare|preschool|teaching|curriculum|librarian)"),
    ("Driver & Logistics", r"(driver|truck|\bcdl\b|courier|delivery|freight|dispatch|warehouse|fleet|hauler|forklift|supply chain|logistic)"),
    ("Construction & Real Estate", r"(construction|contractor|electrician|plumber|carpenter|\bhvac\b|welder|mason|roofer|real estate|realtor|property manag|leasing|superintendent|surveyor|estimator)"),
    ("Accountant & Finance", r"(accountant|accounting|bookkeep|auditor|\btax\b|payroll|controller|treasur|underwrit|\bloan\b|mortgage|financial analyst|finance|financial|banker|banking|teller|actuar)"),
    ("HR Specialist", r"(human resources|\bhr\b|recruit|talent acquisition|staffing)"),
    ("Project Manager", r"(project manager|program manager|scrum master)"),
    ("Product Manager", r"(product manager|product owner)"),
    ("Consultant", r"(consultant|advisory)"),
    ("Customer Service Representative", r"(customer service|call center|customer support|receptionist|\bcsr\b|client service|customer care)"),
    ("Marketing Specialist", r"(marketing|advertis|\bseo\b|social media|public relations|copywriter|brand manager|communications|market research)"),
    ("Designer", r"(designer|graphic|\bux\b|\bui\b|illustrat|photograph|videograph|animat|art director|video editor)"),
    ("Sales Representative", r"(sales|retail|store manager|store associate|merchandis|cashier|account executive|business development|account manager)"),
    ("Data Analyst", r"(data analy|business analyst|business intelligence|reporting analyst|systems analyst|\banalyst\b)"),
    ("Software Developer", r"(software|developer|programmer|full.?stack|front.?end|back.?end|web develop|mobile develop|database|\bdba\b|cloud|solutions architect)"),
    ("Executive", r"(\bceo\b|\bcfo\b|\bcoo\b|\bcto\b|chief|president|general manager|managing director|executive director|vice president|\bvp\b)"),
]

INDUSTRY = [
    ("Healthcare & Caregiving", r"(nurse|nursing|physician|medical|clinical|dental|therapist|caregiv|pharmac|veterinar|hospice|patient|health|radiolog|surgeon|paramedic)"),
    ("Logistics & Transportation", r"(driver|truck|\bcdl\b|delivery|logistic|warehouse|dispatch|freight|courier|fleet|forklift|supply chain|shipping)"),
    ("Legal & Government", r"(attorney|lawyer|paralegal|legal|litigation|police|firefighter|correction|public safety|court)"),
    ("Education & Research", r"(teacher|professor|lecturer|tutor|instructor|educat|faculty|school|childcare)"),
    ("Finance & Banking", r"(accountant|accounting|bookkeep|auditor|\btax\b|finance|financial|bank|teller|loan|mortgage|underwrit|actuar|investment|payroll)"),
    ("Technology & IT", r"(software|developer|programmer|devops|cybersecur|\bit\b|information technology|data|network|sysadmin|cloud|computer)"),
    ("Construction & Real Estate", r"(construction|electrician|plumber|carpenter|\bhvac\b|welder|mason|roofer|contractor|real estate|realtor|property|civil|structural|surveyor)"),
    ("Manufacturing & Industrial", r"(manufactur|production|assembler|machine operator|plant|fabricat|\bcnc\b|industrial|inspector|mechanic|millwright|machinist)"),
    ("Hospitality & Travel", r"(cook|chef|server|bartender|barista|hotel|restaurant|hospitality|housekeep|food|banquet|culinary|waiter|lodging|tourism)"),
    ("Marketing & Media", r"(marketing|advertis|\bseo\b|social media|public relations|copywriter|brand|journalist|editor|media|communications|broadcast)"),
    ("Creative & Design", r"(designer|graphic|\bux\b|creative|illustrat|photograph|videograph|animat|\bart\b|musician|artist)"),
    ("Energy & Utilities", r"(energy|\bpower\b|solar|\boil\b|\bgas\b|petroleum|utility|lineman|drilling|refinery|pipeline|mining)"),
    ("Agriculture & Primary", r"(farm|agricultur|\bcrop\b|livestock|forestry|fisher|landscap|greenhouse|harvest|ranch)"),
    ("Retail & E-commerce", r"(retail|cashier|store|sales associate|merchandis|stocker)"),
]

# Clinical titles, then office titles, then trades.
COLLAR = [
    ("Blue", r"\b(nurse|rn|lpn|cna|physician|surgeon|therapist|pharmacist|paramedic|emt|caregiver|phlebotom|patient care|home health|medical assistant|dental hygienist)\b"),
    ("White", r"\b(engineer|developer|programmer|architect|analyst|scientist|accountant|bookkeeper|auditor|actuary|underwriter|controller|economist|consultant|attorney|lawyer|paralegal|counsel|manager|director|planner|designer|strategist|recruiter|marketer)\b"),
    ("Blue", r"\b(driver|driving|cdl|trucker|warehouse|forklift|welder|plumber|electrician|mechanic|labou?rer|carpenter|roofer|janitor|custodian|cleaner|housekeep|security guard|assembler|machinist|picker|packer|construction|maintenance|cook|chef|server|bartender|barista|cashier|stocker|courier|delivery|landscap)\b"),
]

REMOTE_MODE = [
    ("Remote", r"(fully[ -]remote|100% *remote|work from home|\bwfh\b|\( *remote *\)|telecommut)"),
    ("Hybrid", r"\bhybrid\b"),
    ("On-site", r"\b(on[ -]?site|onsite|in[ -]person|in[ -]office)\b"),
    ("On-site", r"\b(nurse|rn|lpn|cna|physician|surgeon|therapist|pharmacist|paramedic|caregiver|driver|driving|cdl|trucker|warehouse|forklift|welder|plumber|electrician|mechanic|labou?rer|carpenter|roofer|janitor|custodian|cleaner|housekeep|security guard|assembler|machinist|picker|packer|construction|maintenance|cook|chef|server|bartender|barista|cashier|stocker|courier|delivery|landscap)\b"),
]

PER_DIEM = r"\b(per diem|perdiem|prn)\b"
TRAVEL = r"\b(travel (nurse|rn|allied|therapist|tech)|locum)\b"
WEEKS = r"\b\d{1,2} *[- ]?week (contract|assignment)\b"
GIG_PLATFORM = r"\b(uber|lyft|doordash|instacart|grubhub|postmates|shipt|amazon *flex|gopuff|spark driver|roadie)\b"
GIG_ACTIVITY = r"\b(driv|deliver|courier|rideshare|shopper|gig)\b"
JOB_TYPE_WORDS = [
    ("Internship", r"\binternship?\b"),
    ("Part-time", r"\bpart[ -]?time\b"),
    ("Full-time", r"\bfull[ -]?time\b"),
    ("Temporary", r"\b(temp|temporary|seasonal)\b"),
    ("Contract", r"\b(contract|contractor|1099)\b"),
]

EXPERIENCE = [
    ("Executive", r"\b(chief|c[etofi]o|president|founder|partner)\b"),
    ("Senior", r"\b(vp|vice president|head of|director)\b"),
    ("Senior", r"\b(principal|staff|lead|senior|sr\.?)\b"),
    ("Entry", r"\b(junior|jr\.?|entry[ -]?level|trainee|apprentice|intern|graduate|new grad)\b"),
]

METHOD = "keyword_25v1"
CONFIDENCE = 0.95
CHUNK_ROWS = 20000
