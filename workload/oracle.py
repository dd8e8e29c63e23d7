"""The registered queries in SQL, written apart from the engine, for comparison on the same tables."""

from __future__ import annotations

import re

# Shared subqueries. Each registered text takes in the ones it names, directly or through others.
CTES: dict[str, str] = {}

CTES["traffic"] = """SELECT * FROM (VALUES
 (0,'(direct)','(none)'),(1,'google','cpc'),(2,'google','organic'),(3,'google','referral'),(4,'bing','organic'),
 (5,'bing','cpc'),(6,'search.yahoo.com','referral'),(7,'mail.yahoo.com','referral'),(8,'yandex.ru','organic'),
 (9,'ya.ru','referral'),(10,'NN_banner','cpc'),(11,'nnads','cpc'),(12,'fb','paid'),(13,'ig','social'),
 (14,'Meta_ads','cpc'),(15,'metabase','referral'),(16,'fb-promo','cpc'),(17,'MS_network','cpc'),(18,'ms','cpc'),
 (19,'msn','organic'),(20,'SMS_promo','sms'),(21,'SMS','sms'),(22,'NativeAds','cpc'),(23,'intent','cpc'),
 (24,'Prodigi','cpc'),(25,'adfox','video'),(26,'LinkedIn_ads','cpc'),(27,'lnkd.in','referral'),(28,'sfmc','crm'),
 (29,'partner','email'),(30,'Viber_bot','msg'),(31,'telegram.org','referral'),(32,'survey1','web'),
 (33,'Mastercard','promo'),(34,'landing','web'),(35,'news.am','referral'),(36,'chatgpt.com','referral'),
 (37,'(not set)','(not set)'),(38,NULL,'email'),(39,NULL,'referral'),(40,'blog.example','referral'),
 (41,'news.am:8080','web')) AS t(i, source, medium)"""

CTES["page_list"] = """SELECT * FROM (VALUES
 (0,'https://www.mybank.am/'),(1,'https://www.mybank.am/hy/Individual/consumer-loans'),
 (2,'https://www.mybank.am/en/1-click'),(3,'https://sprint.example/start'),(4,'https://www.mybank.am/en/refinance'),
 (5,'https://www.mybank.am/en/car-loan'),(6,'https://www.mybank.am/ru/mortgage'),
 (7,'https://www.mybank.am/en/deposit/simple'),(8,'https://www.mybank.am/en/visa-gold'),
 (9,'https://x.example/discard'),(10,'https://www.mybank.am/mymobile'),(11,'https://www.mybank.am/current-account'),
 (12,'https://www.mybank.am/en/Business/x'),(13,'https://x.example/salary'),(14,'https://x.example/black-friday'),
 (15,'https://www.mybank.am/hy/other'),(16,'https://reg.example/sign-in'),
 (17,'https://www.mybank.am/en/contact-us?card=1'),(18,'https://www.mybank.am/en/faq'),(19,NULL),
 (20,'https://x.example/else')) AS t(i, page_location)"""

CTES["event_list"] = """SELECT * FROM (VALUES
 ('click',0,'sprint_apply_button_click'),('click',1,'reg_apply_button_click'),('click',2,'cards_apply_button'),
 ('click',3,'apply_button_click'),('click',4,'check_limit_click'),('click',5,'sign_in_click'),
 ('click',6,'Reg_apply_button_click'),
 ('signup',0,'Get Sub ID sprint'),('signup',1,'Get Sub ID'),('signup',2,'phone_submited_sprint'),
 ('signup',3,'phone_submited_reg'),('signup',4,'spint_ssn_sumpited'),('signup',5,'kyc_start'),
 ('signup',6,'registration_success'),
 ('purchase',0,'registration_success'),('purchase',1,'sprint_check_limit_comleted'),
 ('purchase',2,'otp_submited_sprint'),('purchase',3,'ssn_submitted'),('purchase',4,'otp_email_verified'),
 ('purchase',5,'sprint_open_personal_account'),('purchase',6,'login via mymob sprint'),
 ('error',0,'test_visa_p'),('error',1,'exchange_page_view'),('error',2,'file_download'),
 ('error',3,'sprint_login_mobile_start'),('error',4,'kyc_qr_shown'),('error',5,'kyc_qr_scanned'),
 ('error',6,'user_engagement')) AS t(event_type, r, event_name)"""

CTES["flat"] = """SELECT e.event_id, CAST(e.ts AS DATE) AS event_date, e.ts AS event_timestamp,
  COALESCE(n.event_name, 'page_view') AS event_name,
  CASE WHEN e.event_id % 211 <> 0 THEN 'u' || e.user_id END AS user_pseudo_id,
  CASE WHEN e.user_id % 4 = 0 THEN 'login' || e.user_id END AS user_id,
  CASE WHEN e.event_id % 97 <> 0 THEN e.sid END AS session_id,
  (e.user_id * 7 + e.sid * 3) % 5 + 1 AS session_number,
  p.page_location, 'Page ' || ((e.k + e.event_id) % 21) AS page_title,
  CASE WHEN e.k % 2 = 0 THEN 'https://ref.example/' END AS page_referrer,
  t.source, t.medium,
  CASE WHEN e.user_id % 6 <> 0 THEN 'camp_' || (e.user_id % 6) END AS campaign,
  CASE WHEN e.event_type = 'signup' THEN 'tok' || e.k END AS access_token_sub_id,
  CASE WHEN e.k % 10 <> 0 THEN CAST(floor(e.value * 100) AS BIGINT) END AS engagement_time_msec,
  CAST(CASE WHEN e.value >= 10 THEN 1 ELSE 0 END AS BIGINT) AS session_engaged,
  ['mobile','desktop','tablet'][e.user_id % 3 + 1] AS device_category,
  ['Apple','Samsung',NULL][e.user_id % 3 + 1] AS device_brand,
  ['iOS','Windows','Android'][e.user_id % 3 + 1] AS device_os,
  ['Safari','Chrome'][e.user_id % 2 + 1] AS browser,
  CASE WHEN e.user_id % 5 = 4 THEN 'Georgia' ELSE 'Armenia' END AS country,
  ['Yerevan','Gyumri','Vanadzor',NULL,'Tbilisi'][e.user_id % 5 + 1] AS city,
  'WEB' AS platform
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
        CAST(dayofmonth(ts) * 4 + hour(ts) // 6 AS BIGINT) AS sid FROM events) e
JOIN traffic t ON t.i = (e.user_id + e.sid) % 42
JOIN page_list p ON p.i = (e.k + e.event_id) % 21
LEFT JOIN event_list n ON n.event_type = e.event_type AND n.r = e.k % 7"""

# Classification: every (label, pattern) pair is a row; the smallest rank that matches wins.
CTES["source_patterns"] = """SELECT * FROM (VALUES
 (1,'Direct','(direct)'),(2,'Google','google'),(3,'Bing','bing'),(4,'Yahoo','%yahoo%'),
 (5,'Yandex','%yandex%'),(5,'Yandex','ya.%'),(6,'NN Ads','NN%'),(6,'NN Ads','nn%'),
 (7,'Meta','fb'),(7,'Meta','ig'),(7,'Meta','FB'),(7,'Meta','%Meta%'),(7,'Meta','%meta%'),(7,'Meta','%facebook%'),
 (7,'Meta','%instagram%'),(7,'Meta','fb_%'),(7,'Meta','fb-%'),(7,'Meta','%fbads%'),(7,'Meta','%FBads%'),
 (8,'MS Network','%MS_%'),(8,'MS Network','%MS-%'),(8,'MS Network','ms_%'),(8,'MS Network','ms-%'),
 (8,'MS Network','MS'),(8,'MS Network','ms'),(8,'MS Network','%mediasystem%'),(8,'MS Network','%MediaSystem%'),
 (9,'Native Ads','%Native%'),(9,'Native Ads','%native%'),(10,'Intent Ads','%intent%'),(10,'Intent Ads','%Intent%'),
 (11,'Prodigi Ads','%prodigi%'),(11,'Prodigi Ads','%Prodigi%'),(12,'Adfox','adfox'),
 (13,'LinkedIn','%linkedin%'),(13,'LinkedIn','%lnkd%'),(13,'LinkedIn','LinkedIn_ads'),
 (14,'Email','email'),(14,'Email','sfmc'),(14,'Email','Mailing'),(14,'Email','mailing'),(14,'Email','%mail.%'),
 (15,'SMS','SMS'),(15,'SMS','%sms%'),(17,'Telegram','%telegram%'),(17,'Telegram','Telegram'),
 (18,'Survey','%survey%'),(19,'Mastercard Promo','%Mastercard%'),(19,'Mastercard Promo','%mastercard%'),
 (20,'Internal','%mybank%'),(20,'Internal','landing'),(21,'Armenian Sites','%.am'),(21,'Armenian Sites','%.am:%'),
 (22,'AI Tools','chatgpt%'),(22,'AI Tools','claude%'),(22,'AI Tools','gemini%'),(22,'AI Tools','copilot%'),
 (22,'AI Tools','perplexity%'),(23,'Data Not Available','(not set)')) AS t(rank, label, pattern)"""

CTES["channel_patterns"] = """SELECT * FROM (VALUES
 (1,'Direct','(direct)',NULL),(2,'Google Ads','google','cpc'),(3,'Google Organic','google','organic'),
 (4,'Meta Ads','%Meta%',NULL),(4,'Meta Ads','fb',NULL),(4,'Meta Ads','ig',NULL),(4,'Meta Ads','FB',NULL),
 (4,'Meta Ads','%instagram%',NULL),(4,'Meta Ads','%facebook%',NULL),(4,'Meta Ads','fb_%',NULL),
 (4,'Meta Ads','%fbads%',NULL),(5,'NN Ads','NN%',NULL),(5,'NN Ads','nn%',NULL),(6,'MS Network','%MS_%',NULL),
 (6,'MS Network','%MS-%',NULL),(6,'MS Network','ms_%',NULL),(6,'MS Network','ms-%',NULL),(6,'MS Network','MS',NULL),
 (6,'MS Network','%mediasystem%',NULL),(6,'MS Network','%MediaSystem%',NULL),(7,'Native Ads','%Native%',NULL),
 (7,'Native Ads','%native%',NULL),(8,'Intent Ads','%intent%',NULL),(8,'Intent Ads','%Intent%',NULL),
 (9,'Prodigi Ads','%prodigi%',NULL),(9,'Prodigi Ads','%Prodigi%',NULL),(10,'Adfox Video','adfox',NULL),
 (11,'LinkedIn','%linkedin%',NULL),(11,'LinkedIn','%lnkd%',NULL),(11,'LinkedIn','LinkedIn_ads',NULL),
 (12,'Email','email',NULL),(12,'Email','sfmc',NULL),(12,'Email','Mailing',NULL),(12,'Email','mailing',NULL),
 (12,'Email','%mail.%',NULL),(12,'Email',NULL,'email'),(13,'SMS','SMS',NULL),(13,'SMS','%sms%',NULL),
 (15,'Telegram','%telegram%',NULL),(15,'Telegram','Telegram',NULL),(16,'Yandex','%yandex%',NULL),
 (16,'Yandex','ya.%',NULL),(17,'Bing Organic','bing','organic'),(18,'Yahoo','%yahoo%',NULL),
 (19,'Survey','%survey%',NULL),(20,'Referral',NULL,'referral')) AS t(rank, label, pattern, medium)"""

CTES["page_patterns"] = """SELECT * FROM (VALUES
 (1,'Support & Info','%/contact%'),(1,'Support & Info','%/faq%'),(1,'Support & Info','%/about-mybank%'),
 (1,'Support & Info','%/useful-information%'),(1,'Support & Info','%/career%'),(1,'Support & Info','%/press-center%'),
 (1,'Support & Info','%/shareholders%'),(1,'Support & Info','%/corporate-governance%'),(1,'Support & Info','%/reports%'),
 (2,'Consumer Loans','%consumer-loans%'),(2,'Consumer Loans','%1-click%'),(2,'Consumer Loans','%sprint%'),
 (2,'Consumer Loans','%refinance%'),(2,'Consumer Loans','%refinans%'),(3,'Car Loans','%car-loan%'),
 (3,'Car Loans','%avtovark%'),(4,'Mortgage','%mortgage%'),(5,'Deposits','%deposit%'),(6,'Cards','%card%'),
 (6,'Cards','%visa%'),(6,'Cards','%Mastercard%'),(7,'Digital Banking','%mymobile%'),(7,'Digital Banking','%myonline%'),
 (8,'Accounts','%account%'),(9,'Business','%/Business%'),(9,'Business','%/business%'),(10,'Salary Project','%salary%'),
 (11,'Campaigns','%christmas%'),(11,'Campaigns','%black-friday%'),(11,'Campaigns','%cyber-monday%'),
 (11,'Campaigns','%pascali%'),(11,'Campaigns','%new-year%'),(12,'Homepage','%mybank.am/hy%'),
 (12,'Homepage','%mybank.am/en%'),(12,'Homepage','%mybank.am/ru%'),(12,'Homepage','%mybank.am'),
 (12,'Homepage','%mybank.am/'),(13,'User Account','%user-info%'),(13,'User Account','%personal-info%'),
 (13,'User Account','%provision%'),(13,'User Account','%sign-in%')) AS t(rank, label, pattern)"""

CTES["traffic_labels"] = """SELECT d.source, d.medium,
  COALESCE((SELECT arg_min(label, rank) FROM (
      SELECT rank, label FROM source_patterns WHERE d.source LIKE pattern
      UNION ALL SELECT 14, 'Email' WHERE d.medium = 'email'
      UNION ALL SELECT 16, 'Viber' WHERE lower(d.source) LIKE '%viber%'
      UNION ALL SELECT 23, 'Data Not Available' WHERE d.source IS NULL)), 'Other') AS source_clean,
  COALESCE((SELECT arg_min(label, rank) FROM (
      SELECT rank, label FROM channel_patterns c
      WHERE (c.pattern IS NULL OR d.source LIKE c.pattern) AND (c.medium IS NULL OR d.medium = c.medium)
      UNION ALL SELECT 14, 'Viber' WHERE lower(d.source) LIKE '%viber%')), 'Other') AS channel_group
FROM (SELECT DISTINCT source, medium FROM flat) d"""

CTES["page_labels"] = """SELECT d.page_location,
  COALESCE((SELECT arg_min(label, rank) FROM page_patterns WHERE d.page_location LIKE pattern), 'Other') AS product_category
FROM (SELECT DISTINCT page_location FROM flat) d"""

CTES["staged"] = """SELECT f.*, t.source_clean, t.channel_group, p.product_category
FROM flat f
JOIN traffic_labels t ON t.source IS NOT DISTINCT FROM f.source AND t.medium IS NOT DISTINCT FROM f.medium
JOIN page_labels p ON p.page_location IS NOT DISTINCT FROM f.page_location"""

CTES["mapping"] = """SELECT * FROM (VALUES
 ('Get Sub ID sprint','sprint_sub_id_captured','Sprint',3),('phone_submited_sprint','sprint_phone_submitted','Sprint',4),
 ('login via mymob sprint','sprint_login_via_mobile','Sprint',4),('spint_ssn_sumpited','sprint_ssn_submitted','Sprint',7),
 ('check_limit_click','sprint_check_limit_click','Sprint',8),
 ('sprint_check_limit_comleted','sprint_check_limit_completed','Sprint',9),
 ('Get Sub ID','reg_sub_id_captured','Registration',2),('phone_submited_reg','reg_phone_submitted','Registration',3),
 ('ssn_submitted','reg_ssn_submitted','Registration',4),('otp_email_verified','reg_email_verified','Registration',5),
 ('kyc_start','kyc_started','Registration',6),('registration_success','reg_completed','Registration',9),
 ('sprint_apply_button_click','sprint_apply_click','Sprint',2),
 ('reg_apply_button_click','reg_apply_click','Registration',1),('cards_apply_button','cards_apply_click','Registration',1),
 ('apply_button_click','apply_click','General',1)) AS t(event_name, clean_event, flow, step)"""

CTES["clean"] = """SELECT s.*, COALESCE(m.clean_event, s.event_name) AS event_name_clean, COALESCE(m.flow, 'Other') AS flow_type,
  CAST(m.step AS INTEGER) AS funnel_step,
  COALESCE(starts_with(s.event_name, 'test_') OR starts_with(s.event_name, 'exchange_') OR s.user_pseudo_id = 'u1', FALSE) AS is_test_event
FROM staged s LEFT JOIN mapping m USING (event_name)"""

CTES["documented"] = """SELECT s.*,
  CASE m.clean_event WHEN 'sprint_sub_id_captured' THEN 'sprint_otp_requested' WHEN 'reg_sub_id_captured' THEN 'reg_otp_requested'
    WHEN 'sprint_check_limit_click' THEN s.event_name WHEN 'kyc_started' THEN s.event_name
    ELSE COALESCE(m.clean_event, s.event_name) END AS event_name_clean,
  CASE WHEN m.clean_event IN ('sprint_check_limit_click', 'kyc_started') THEN 'Other' ELSE COALESCE(m.flow, 'Other') END AS flow_type
FROM staged s LEFT JOIN mapping m USING (event_name)"""

CTES["rollup"] = """SELECT event_date AS date, source_clean, channel_group, COALESCE(campaign, '(not set)') AS campaign,
  device_category, product_category, country, city, user_pseudo_id, session_id,
  CASE WHEN session_number = 1 THEN 'New' ELSE 'Returning' END AS user_type,
  COUNT(*) FILTER (WHERE event_name = 'page_view') AS pageviews,
  CAST(COALESCE(SUM(engagement_time_msec), 0) AS BIGINT) AS engagement_msec, MAX(session_engaged) AS session_engaged
FROM staged GROUP BY ALL"""

CTES["fs"] = """SELECT date, source_clean, channel_group, campaign, device_category, product_category, country, city, user_type,
  COUNT(DISTINCT user_pseudo_id) AS users,
  COUNT(DISTINCT user_pseudo_id) FILTER (WHERE user_type = 'New') AS new_users,
  COUNT(*) AS sessions,
  COUNT(*) FILTER (WHERE pageviews = 1 AND engagement_msec / 1000.0 < 10) AS bounced_sessions,
  CAST(SUM(pageviews) AS BIGINT) AS pageviews,
  CAST(SUM(engagement_msec) AS BIGINT) / 1000.0 / COUNT(*) AS avg_session_duration_sec,
  AVG(pageviews) AS avg_pages_per_session
FROM rollup GROUP BY ALL"""

FC_KEYS = """event_date AS date, source_clean, channel_group, COALESCE(campaign, '(not set)') AS campaign,
  device_category, product_category, country, city"""


def _users(name: str, test: str, column: str = "user_pseudo_id") -> str:
    return f"COUNT(DISTINCT {column}) FILTER (WHERE {test}) AS {name}"


def _event(name: str, *events: str, column: str = "event_name", extra: str = "") -> str:
    names = ", ".join(f"'{e}'" for e in events)
    return _users(name, f"{column} IN ({names}){extra}")


TOTALS = "COUNT(DISTINCT user_pseudo_id) AS total_users, COUNT(DISTINCT user_pseudo_id || session_id) AS total_sessions"
LOAN_VIEW = _users("loans_pageview", "event_name = 'page_view' AND product_category = 'Consumer Loans'")
CARD_VIEW = _users("cards_deposits_pageview", "event_name = 'page_view' AND product_category IN ('Cards', 'Deposits')")

CTES["fc"] = f"""SELECT {FC_KEYS}, {TOTALS}, {LOAN_VIEW},
  {_event('loans_apply_click', 'sprint_apply_button_click')}, {_event('loans_sub_id', 'Get Sub ID sprint')},
  {_event('loans_check_limit', 'check_limit_click')}, {_event('loans_phone_submit', 'phone_submited_sprint')},
  {_event('loans_otp_submit', 'otp_submited_sprint')}, {CARD_VIEW},
  {_event('cards_deposits_apply_click', 'reg_apply_button_click', 'cards_apply_button', 'apply_button_click')},
  {_event('cards_deposits_sub_id', 'Get Sub ID')}, {_event('cards_deposits_phone_submit', 'phone_submited_reg')},
  {_event('registrations', 'registration_success')}
FROM staged GROUP BY ALL"""


def _clean(name: str, *events: str, extra: str = "") -> str:
    return _event(name, *events, column="event_name_clean", extra=extra)


CTES["fc_clean"] = f"""SELECT {FC_KEYS}, {TOTALS}, {LOAN_VIEW},
  {_clean('loans_apply_click', 'sprint_apply_click')}, {_clean('loans_sub_id', 'sprint_sub_id_captured')},
  {_clean('loans_check_limit', 'sprint_check_limit_click')}, {_clean('loans_phone_submit', 'sprint_phone_submitted')},
  {_clean('loans_completed', 'sprint_check_limit_completed', extra=' AND NOT is_test_event')}, {CARD_VIEW},
  {_clean('cards_deposits_apply_click', 'reg_apply_click', 'cards_apply_click')},
  {_clean('cards_deposits_sub_id', 'reg_sub_id_captured')}, {_clean('cards_deposits_phone_submit', 'reg_phone_submitted')},
  {_clean('registrations', 'reg_completed')}
FROM clean GROUP BY ALL"""

CTES["channels"] = """SELECT row_number() OVER (ORDER BY channel_group, source_clean) AS channel_key, source_clean, channel_group,
  CASE WHEN paid THEN 'Paid' WHEN channel_group IN ('Google Organic','Bing Organic','Yahoo','Yandex') THEN 'Organic Search'
    WHEN channel_group IN ('Email','SMS','Viber','Telegram') THEN 'CRM'
    WHEN channel_group IN ('Direct','Referral') THEN channel_group ELSE 'Other' END AS channel_type,
  paid AS is_paid,
  CASE WHEN source_clean IN ('Google','Meta') THEN source_clean
    WHEN source_clean IN ('NN Ads','MS Network','Native Ads','Intent Ads','Prodigi Ads') THEN 'Local Ad Networks'
    WHEN source_clean IN ('Email','SMS','Viber','Telegram') THEN 'Direct Messaging'
    WHEN source_clean IN ('Yandex','Bing','Yahoo') THEN 'Other Search' ELSE 'Other' END AS channel_category
FROM (SELECT DISTINCT source_clean, channel_group, channel_group IN (SELECT name FROM paid_list) AS paid FROM staged)"""

CTES["paid_list"] = """SELECT unnest(['Google Ads','Meta Ads','NN Ads','MS Network','Native Ads','Intent Ads','Prodigi Ads',
  'Adfox Video','LinkedIn']) AS name"""

CTES["google"] = """SELECT DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS date, 'Google Ads' AS channel_group,
  'camp_' || (l_partkey % 6) AS campaign, 'ag_' || l_linenumber AS ad_group,
  floor(l_quantity) * (l_partkey % 20) AS impressions, CAST(l_partkey % 50 AS DOUBLE) AS clicks,
  floor(l_extendedprice * 10000) / 1000000 AS spend_usd, floor(l_extendedprice * 10000) / 1000000 * 400 AS spend_amd,
  CAST(l_suppkey % 4 AS DOUBLE) AS conversions
FROM lineitem WHERE l_returnflag = 'R'"""

CTES["meta"] = """SELECT DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS date,
  'camp_' || (l_partkey % 6) AS campaign, 'set_' || l_linenumber AS ad_group,
  floor(l_quantity) * (l_partkey % 20) AS impressions, CAST(l_partkey % 50 AS DOUBLE) AS clicks,
  l_extendedprice / 100 AS spend_usd, l_extendedprice / 100 * 400 AS spend_amd, CAST(l_partkey AS DOUBLE) AS reach
FROM lineitem WHERE l_returnflag <> 'R'"""


def _per(a: str, b: str, scale: str = "") -> str:
    return f"CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}){scale} END"


RATES = f"{_per('clicks', 'impressions', ' * 100')} AS ctr, {_per('spend_usd', 'clicks')} AS cpc, {_per('spend_usd', 'impressions', ' * 1000')} AS cpm"

CTES["spend_google"] = f"""SELECT date, channel_group, campaign, ad_group, impressions, clicks, spend_usd, spend_amd, {RATES},
  conversions, {_per('spend_usd', 'conversions')} AS cost_per_conversion FROM google"""

CTES["spend"] = f"""SELECT * FROM spend_google UNION ALL
SELECT date, 'Meta Ads', campaign, ad_group, impressions, clicks, spend_usd, spend_amd, {RATES}, 0.0, 0.0 FROM meta"""

CTES["landed"] = """SELECT DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS date,
  ['google_ads','meta_ads','linkedin'][l_suppkey % 3 + 1] AS channel, 'camp_' || (l_partkey % 6) AS campaign_name,
  CAST(floor(l_quantity) AS BIGINT) AS impressions, l_partkey % 50 AS clicks, l_extendedprice AS cost,
  ['USD','amd'][l_linenumber % 2 + 1] AS currency FROM lineitem"""

CTES["bank_raw"] = """SELECT strftime(o_orderdate, '%Y-%m-%d') AS event_time_raw,
  DATE '2024-01-01' + CAST(o_custkey % 30 AS INTEGER) AS event_date, 'approved' AS event_name,
  't' || o_orderkey AS token_id,
  ['Meta_ads','google','NN ads','sfmc','SMS','landing','yandex','ms_network',NULL][o_orderkey % 9 + 1] AS acquired_source,
  ['cpc','email','referral',NULL][o_orderkey % 4 + 1] AS acquired_medium,
  'camp_' || (o_custkey % 6) AS acquired_campaign, 'c' || o_custkey AS client_code,
  CAST(NULL AS VARCHAR) AS soc_card, CAST(0 AS BIGINT) AS count_soc_card,
  CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS had_product, o_orderkey % 2 AS is_first_interaction,
  CAST(o_orderkey % 5 = 0 AS BIGINT) AS loan_count, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice ELSE 0.0 END AS loan_amount,
  CAST(o_orderkey % 5 = 1 AS BIGINT) AS deposit_count, CASE WHEN o_orderkey % 5 = 1 THEN o_totalprice ELSE 0.0 END AS deposit_amount,
  CAST(o_orderkey % 5 IN (0, 2) AS BIGINT) AS card_count, TIMESTAMP '2024-01-30 06:00:00' AS uploaded_at
FROM orders"""

CTES["bank_patterns"] = """SELECT * FROM (VALUES
 (1,'Meta Ads','%meta%',NULL),(1,'Meta Ads','facebook%',NULL),(2,'Google Ads','google','cpc'),(3,'NN Ads','%nn_ads%',NULL),
 (3,'NN Ads','%nn ads%',NULL),(4,'Email','sfmc',NULL),(4,'Email',NULL,'email'),(5,'SMS','sms',NULL),(5,'SMS',NULL,'%sms%'),
 (6,'Viber','%viber%',NULL),(7,'Telegram','%telegram%',NULL),(8,'Referral',NULL,'referral'),(9,'Direct','landing',NULL),
 (10,'Yandex','%yandex%',NULL),(11,'Native Ads','%native%',NULL),(12,'Intent Ads','%intent%',NULL),
 (13,'Prodigi Ads','%prodigi%',NULL),(14,'MS Network','%ms_network%',NULL)) AS t(rank, label, source, medium)"""

CTES["bank_labels"] = """SELECT d.acquired_source, d.acquired_medium,
  COALESCE((SELECT arg_min(label, rank) FROM bank_patterns p
    WHERE (p.source IS NULL OR lower(d.acquired_source) LIKE p.source)
      AND (p.medium IS NULL OR lower(d.acquired_medium) LIKE p.medium)), 'Other') AS channel_group
FROM (SELECT DISTINCT acquired_source, acquired_medium FROM bank_raw) d"""

CTES["bank"] = """SELECT event_date AS date, l.channel_group,
  CASE WHEN loan_count > 0 THEN 'Loans' WHEN card_count > 0 THEN 'Cards' WHEN deposit_count > 0 THEN 'Deposits' ELSE 'Other' END
    AS product_category,
  b.acquired_source, b.acquired_medium, acquired_campaign, had_product AS is_existing_customer, is_first_interaction,
  loan_count, loan_amount, deposit_count, deposit_amount, card_count, loan_amount + deposit_amount AS total_revenue_amd
FROM bank_raw b JOIN bank_labels l
  ON l.acquired_source IS NOT DISTINCT FROM b.acquired_source AND l.acquired_medium IS NOT DISTINCT FROM b.acquired_medium"""

CTES["bank_days"] = """SELECT date, sum(total_revenue_amd) AS v, CAST(sum(loan_count + card_count + deposit_count) AS BIGINT) AS c
FROM bank GROUP BY 1"""

CTES["apps"] = """SELECT 'APP-' || o_orderkey AS application_id, ['loan','card','deposit'][o_orderkey % 3 + 1] AS product_type,
  DATE '2024-01-01' + CAST(o_custkey % 30 AS INTEGER) AS apply_date,
  ['google','meta','direct'][o_orderkey % 3 + 1] AS apply_source,
  ['google_ads','meta_ads','direct'][(o_orderkey + o_custkey) % 3 + 1] AS apply_channel,
  CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'rejected' ELSE 'pending' END AS status,
  CASE WHEN o_orderstatus = 'F' THEN DATE '2024-01-01' + CAST(o_custkey % 30 + o_orderkey % 7 + 1 AS INTEGER) END AS approval_date,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END AS revenue_amd
FROM orders"""

CTES["targets"] = """SELECT DATE '2024-01-01' AS period, * FROM (VALUES
 ('revenue','all','all',400000000.0),('revenue','all','loan',200000000.0),('revenue','all','card',150000000.0),
 ('revenue','all','deposit',100000000.0),('approved','all','all',5000.0),('approved','all','loan',2000.0),
 ('cpa','all','all',3000.0),('cpa','google_ads','all',2500.0),('cpa','meta_ads','all',2000.0),('roas','all','all',0.05),
 ('roas','google_ads','all',0.04),('roas','meta_ads','all',0.03),('approval_rate','all','all',35.0),
 ('approval_rate','all','loan',60.0),('approval_rate','all','card',30.0),('revenue','google_ads','loan',60000000.0)) AS t(metric, channel, product, target)"""

CTES["code_list"] = """SELECT * FROM (VALUES ('google_ads','Google Ads'),('meta_ads','Meta Ads'),('linkedin','LinkedIn'),
 ('yandex','Yandex'),('email','Email'),('sms','SMS')) AS t(channel_code, channel_group)"""

CTES["month_level"] = f"""SELECT period, channel, product, a.revenue, a.approved, a.applied, c.spend_usd FROM (
  SELECT date_trunc('month', apply_date)::DATE AS period, 'all' AS channel, 'all' AS product, sum(revenue_amd) AS revenue,
    count(*) FILTER (WHERE status = 'approved') AS approved, count(*) AS applied FROM apps GROUP BY ALL
  UNION ALL SELECT date_trunc('month', apply_date)::DATE, 'all', product_type, sum(revenue_amd),
    count(*) FILTER (WHERE status = 'approved'), count(*) FROM apps GROUP BY ALL
  UNION ALL SELECT date_trunc('month', apply_date)::DATE, apply_channel, 'all', sum(revenue_amd),
    count(*) FILTER (WHERE status = 'approved'), count(*) FROM apps GROUP BY ALL
  UNION ALL SELECT date_trunc('month', apply_date)::DATE, apply_channel, product_type, sum(revenue_amd),
    count(*) FILTER (WHERE status = 'approved'), count(*) FROM apps GROUP BY ALL) a
FULL JOIN (
  SELECT date_trunc('month', date)::DATE AS period, 'all' AS channel, 'all' AS product, sum(spend_usd) AS spend_usd FROM spend GROUP BY ALL
  UNION ALL SELECT date_trunc('month', date)::DATE, channel_code, 'all', sum(spend_usd) FROM spend LEFT JOIN code_list USING (channel_group) GROUP BY ALL
) c USING (period, channel, product)"""

CTES["kpis"] = f"""SELECT period, channel, product, 'revenue' AS metric, revenue AS actual FROM month_level
UNION ALL SELECT period, channel, product, 'approved', CAST(approved AS DOUBLE) FROM month_level
UNION ALL SELECT period, channel, product, 'cpa', {_per('spend_usd', 'approved')} FROM month_level
UNION ALL SELECT period, channel, product, 'roas', {_per('revenue', 'spend_usd * 400.0')} FROM month_level
UNION ALL SELECT period, channel, product, 'approval_rate', {_per('approved', 'applied', ' * 100')} FROM month_level"""

CTES["variances"] = f"""SELECT t.period, t.metric, t.channel, t.product, CAST(t.target AS DOUBLE) AS target_value, k.actual,
  (k.actual - t.target) / t.target * 100 AS variance_pct
FROM targets t LEFT JOIN kpis k USING (period, metric, channel, product)"""

CTES["budget_list"] = """SELECT DATE '2024-01-01' AS period, * FROM (VALUES ('google_ads', 9000000.0::DOUBLE, 290000.0::DOUBLE),
 ('meta_ads', 7000000.0::DOUBLE, 7000000.0::DOUBLE / 31), ('linkedin', 3000.0::DOUBLE, 97.0::DOUBLE)) AS t(channel, monthly, daily)"""

CTES["pacing"] = """SELECT b.period, b.channel, b.monthly AS monthly_budget_usd, b.daily AS daily_budget_usd,
  COALESCE(s.spent, 0) AS spent_usd, b.monthly - COALESCE(s.spent, 0) AS remaining_usd, CAST(7 AS INTEGER) AS days_left,
  (b.monthly - COALESCE(s.spent, 0)) / 7 AS needed_daily_usd, COALESCE(s.spent, 0) / 24 AS current_daily_usd,
  COALESCE(s.spent, 0) / b.monthly * 100 AS spent_pct, COALESCE(s.spent, 0) / (b.monthly * 24 / 31) * 100 AS pacing_pct
FROM budget_list b LEFT JOIN (SELECT channel_code AS channel, sum(spend_usd) AS spent FROM spend JOIN code_list USING (channel_group)
  WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-24' GROUP BY 1) s USING (channel)"""

LOAN_STEPS = ("loans_pageview", "loans_apply_click", "loans_sub_id", "loans_check_limit", "loans_phone_submit", "loans_otp_submit")

CTES["stage_weeks"] = " UNION ALL ".join(
    f"SELECT date_trunc('week', date)::DATE AS week_start, '{s}' AS stage_name, CAST(sum({s}) AS BIGINT) AS users FROM fc GROUP BY 1"
    for s in LOAN_STEPS
)

CTES["stage_change"] = f"""SELECT *, {_per('users - previous', 'previous', ' * 100')} AS change_pct FROM (
  SELECT *, lag(users) OVER (PARTITION BY stage_name ORDER BY week_start) AS previous FROM (
    SELECT week_start, stage_name, COALESCE(users, 0) AS users FROM (SELECT DISTINCT stage_name FROM stage_weeks)
    CROSS JOIN (SELECT unnest(generate_series(min(week_start), max(week_start), INTERVAL 7 DAY))::DATE AS week_start FROM stage_weeks)
    LEFT JOIN stage_weeks USING (week_start, stage_name)))"""

CTES["campaign_list"] = f"""SELECT *, {_per('spend_usd', 'approved')} AS cpa_usd FROM (
  SELECT acquired_campaign AS campaign, channel_group, sum(total_revenue_amd) AS revenue,
    CAST(sum(loan_count + card_count + deposit_count) AS BIGINT) AS approved FROM bank GROUP BY ALL) o
FULL JOIN (SELECT campaign, channel_group, sum(spend_usd) AS spend_usd FROM spend GROUP BY ALL) c USING (campaign, channel_group)"""

CTES["session_chunks"] = """SELECT user_id, ts, event_id,
  CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS starts
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""

CTES["numbered_events"] = """SELECT event_id, user_id, ts,
  CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no FROM session_chunks"""

CTES["merge_old"] = "SELECT * FROM bank_raw WHERE token_id[-1] < '7'"
CTES["merge_new"] = """SELECT * FROM (
  SELECT event_time_raw, event_date, event_name, CASE WHEN token_id NOT LIKE '%77' THEN token_id END AS token_id,
    acquired_source, acquired_medium, acquired_campaign, client_code, had_product, loan_count,
    loan_amount + 1 AS loan_amount, deposit_count, deposit_amount + 1 AS deposit_amount,
    CASE WHEN token_id LIKE '%55' THEN card_count + 10 ELSE card_count END AS card_count,
    CASE WHEN token_id LIKE '%55' THEN TIMESTAMP '2024-01-31 07:00:00' ELSE TIMESTAMP '2024-01-31 06:00:00' END AS uploaded_at
  FROM bank_raw WHERE token_id[-1] >= '5')"""
_MERGE_COLUMNS = ("loan_count", "loan_amount", "deposit_count", "deposit_amount", "card_count", "uploaded_at")
CTES["merged"] = f"""SELECT o.token_id, o.client_code, o.event_date,
  {', '.join(f'CASE WHEN n.token_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}' for c in _MERGE_COLUMNS)},
  o.acquired_source, CASE WHEN n.token_id IS NULL THEN 'keep' ELSE 'update' END AS action
FROM merge_old o LEFT JOIN merge_new n ON o.token_id = n.token_id AND o.client_code = n.client_code AND o.event_date = n.event_date
UNION ALL SELECT n.token_id, n.client_code, n.event_date, {', '.join(f'n.{c}' for c in _MERGE_COLUMNS)}, n.acquired_source, 'insert'
FROM merge_new n WHERE NOT EXISTS (SELECT 1 FROM merge_old o
  WHERE o.token_id = n.token_id AND o.client_code = n.client_code AND o.event_date = n.event_date)"""


def _with(body: str) -> str:
    """Put the shared subqueries the text names in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + body


ORACLE: dict[str, str] = {}


def add(name: str, body: str, doubles: str = "") -> None:
    """Register a text; the listed double columns are rounded to three digits."""
    if doubles:
        listed = ", ".join(f"ROUND(CAST({c} AS DOUBLE), 3) + 0.0 AS {c}" for c in doubles.split())
        body = f"SELECT * REPLACE ({listed}) FROM ({body})"
    ORACLE[name] = _with(body)


# --- sources, staging, projections
add("stg_events", "SELECT * EXCLUDE (event_id) FROM staged")
add(
    "stg_events_recent",
    "SELECT event_date, source_clean, product_category, count(*) AS events FROM staged "
    "WHERE event_date BETWEEN DATE '2024-01-24' AND DATE '2024-01-30' GROUP BY ALL",
)
add(
    "stg_events_clean",
    "SELECT event_date, event_timestamp, event_name, user_pseudo_id, event_name_clean, flow_type, funnel_step, is_test_event FROM clean",
)
add(
    "event_params_strict",
    "SELECT session_id, count(*) AS events, max(session_number) AS max_number, min(page_title) AS first_title FROM staged GROUP BY ALL",
)
add("events_without_tests", "SELECT event_name, count(*) AS events FROM clean WHERE NOT is_test_event GROUP BY ALL")
add(
    "events_without_personal_data",
    "SELECT event_timestamp, event_name, regexp_extract(page_location, '^https?://[^/?#]+([^?#]*)', 1) AS page_location, "
    "regexp_replace(page_referrer, '[?#].*$', '') AS page_referrer, "
    "sha256('fixture' || sha256('fixture' || user_id)) AS user_hash, channel_group FROM staged",
)
add(
    "landing_pages",
    "SELECT regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS landing_page, count(*) AS pages, "
    "CAST(sum(length(html)) AS BIGINT) AS characters FROM pages GROUP BY 1",
)
add("source_channel_matrix", "SELECT source, medium, source_clean, channel_group, count(*) AS events FROM staged GROUP BY ALL")
add("product_pages", "SELECT page_location, product_category, count(*) AS events FROM staged GROUP BY ALL")
add(
    "stg_bank_applications",
    """SELECT 'APP-' || o_orderkey AS application_id, DATE '2024-01-01' + CAST(o_custkey % 30 AS INTEGER) AS application_date,
  CASE WHEN o_orderstatus = 'F' THEN DATE '2024-01-01' + CAST(o_custkey % 30 + 2 AS INTEGER) END AS approved_date,
  ['loan','card','deposit'][o_orderkey % 3 + 1] AS product_type, o_orderpriority AS product_name,
  CASE WHEN o_orderstatus = 'F' THEN 'approved' ELSE 'pending' END AS status,
  '+3740' || (o_orderkey % 90 + 10) || '1234' || o_custkey AS user_phone,
  'client' || o_custkey || '@mail.example' AS user_email, o_totalprice AS amount,
  ['AMD','USD',NULL][o_orderkey % 3 + 1] AS currency FROM orders""",
)
add(
    "stg_bank_conversions",
    "SELECT DISTINCT * EXCLUDE (event_time_raw) FROM bank_raw WHERE token_id NOT LIKE '%13'",
    "loan_amount deposit_amount",
)
add(
    "bank_export_load",
    """SELECT event_time_raw, event_date, CASE WHEN token_id[-1] = '3' THEN 'Кредит' ELSE event_name END AS event_name,
  CASE WHEN token_id[-1] <> '9' THEN token_id END AS token_id, acquired_source, acquired_medium, acquired_campaign, client_code,
  soc_card, count_soc_card, had_product, is_first_interaction, loan_count,
  CASE WHEN token_id[-1] = '6' THEN 0.0 ELSE loan_amount END AS loan_amount, deposit_count, deposit_amount, card_count,
  TIMESTAMP '2024-01-31 06:00:00' AS uploaded_at FROM bank_raw""",
    "loan_amount deposit_amount",
)
add(
    "bank_export_checks",
    """SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS missing_columns, CAST(0 AS BIGINT) AS bad_dates, CAST(0 AS BIGINT) AS empty_dates,
  CAST(0 AS BIGINT) AS empty_clients, count(*) FILTER (WHERE token_id[-1] = '9') AS empty_tokens,
  count(*) FILTER (WHERE token_id[-1] <> '9') - count(DISTINCT token_id) FILTER (WHERE token_id[-1] <> '9') AS duplicate_rows
FROM (SELECT token_id FROM bank_raw UNION ALL SELECT token_id FROM bank_raw WHERE loan_count > 0)""",
)
add(
    "approvals_csv",
    """SELECT application_id, CAST(NULL AS VARCHAR) AS user_id, product_type, apply_date, apply_source, CAST(NULL AS VARCHAR) AS apply_campaign,
  status, approval_date, CAST(NULL AS VARCHAR) AS rejection_reason, CAST(NULL AS DOUBLE) AS approved_amount_amd, revenue_amd,
  CAST(NULL AS VARCHAR) AS notes FROM apps""",
    "revenue_amd",
)
add(
    "monthly_targets_csv",
    """SELECT date_trunc('month', apply_date)::DATE AS period, 'revenue' AS metric, 'all' AS channel, product_type AS product,
  round(sum(revenue_amd)) AS target_value, CAST(NULL AS VARCHAR) AS notes FROM apps GROUP BY ALL""",
    "target_value",
)
add(
    "monthly_budgets_csv",
    """SELECT DATE '2024-01-01' AS period, channel, b AS monthly_budget_usd, CASE WHEN channel = 'linkedin' THEN round(b / 30) ELSE b / 31 END AS daily_budget_usd,
  CAST(NULL AS VARCHAR) AS notes FROM (SELECT channel, round(sum(cost)) AS b FROM landed GROUP BY 1)""",
    "monthly_budget_usd daily_budget_usd",
)
add(
    "uploads_tsv",
    "SELECT date, channel, currency, count(*) AS rows, CAST(sum(impressions) AS BIGINT) AS impressions, sum(cost) AS cost FROM landed GROUP BY ALL",
    "cost",
)
add(
    "manual_ad_spend",
    "SELECT channel_group AS channel, ad_group AS adset, CAST(sum(CAST(clicks AS BIGINT)) AS BIGINT) AS clicks, "
    "sum(spend_usd) AS spend_usd, sum(spend_amd) AS spend_amd FROM spend GROUP BY ALL",
    "spend_usd spend_amd",
)

# --- dimensions and star joins
add(
    "dim_date",
    """SELECT d AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(strftime(d, '%U') AS INTEGER) AS week_of_year,
  CAST(weekofyear(d) AS INTEGER) AS iso_week, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
  CAST(day(d) AS INTEGER) AS day_of_month, date_trunc('week', d)::DATE AS week_start, date_trunc('month', d)::DATE AS month_start,
  date_trunc('quarter', d)::DATE AS quarter_start, dayofweek(d) IN (0, 6) AS is_weekend,
  (month(d), day(d)) IN ((1,1),(1,2),(1,6),(3,8),(4,24),(5,1),(5,9),(5,28),(7,5),(9,21),(12,31)) AS is_holiday,
  COALESCE(n, 0) AS orders
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) USING (d)""",
)
add("dim_channel", "SELECT * FROM channels")
add(
    "product_traffic",
    """SELECT CAST(k AS INTEGER) AS product_key, g AS product_group, product_category, k <= 5 AS has_funnel,
  CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(pageviews) AS BIGINT) AS pageviews
FROM fs JOIN (VALUES (1,'Consumer Loans','Loans'),(2,'Car Loans','Loans'),(3,'Mortgage','Loans'),(4,'Cards','Cards'),
 (5,'Deposits','Deposits'),(6,'Digital Banking','Services'),(7,'Accounts','Services'),(8,'Business','Business'),
 (9,'Salary Project','Services'),(10,'Campaigns','Marketing'),(11,'Homepage','General'),(12,'Support & Info','General'),
 (13,'User Account','General'),(14,'Other','Other')) AS p(k, product_category, g) USING (product_category) GROUP BY ALL""",
)
add(
    "channel_traffic",
    "SELECT channel_key, channel_type, is_paid, channel_category, CAST(sum(sessions) AS BIGINT) AS sessions "
    "FROM fs JOIN channels USING (source_clean, channel_group) GROUP BY ALL",
)
add(
    "weekend_traffic",
    "SELECT date_trunc('week', date)::DATE AS week_start, dayofweek(date) IN (0, 6) AS is_weekend, "
    "(month(date), day(date)) IN ((1,1),(1,2),(1,6)) AS is_holiday, CAST(sum(sessions) AS BIGINT) AS sessions FROM fs GROUP BY ALL",
)

# --- facts and funnels
add("fact_sessions", "SELECT * FROM fs")
add("session_rollup", "SELECT * FROM rollup")
add("fact_conversions", "SELECT * FROM fc")
add("fact_conversions_clean", "SELECT * FROM fc_clean")

LOAN_FUNNEL = ", ".join(
    (
        _clean("step1_apply_click", "sprint_apply_click"),
        _clean("step2_sub_id_captured", "sprint_sub_id_captured"),
        _clean("step3_open_account", "sprint_open_personal_account"),
        _clean("step4_ssn_submitted", "sprint_ssn_submitted"),
        _clean("step5_check_limit", "sprint_check_limit_click"),
        _clean("step6_completed", "sprint_check_limit_completed", extra=" AND NOT is_test_event"),
    )
)
REG_FUNNEL = ", ".join(
    (
        _clean("step1_apply_click", "reg_apply_click", "cards_apply_click"),
        _clean("step2_sub_id_captured", "reg_sub_id_captured"),
        _clean("step3_phone_submitted", "reg_phone_submitted"),
        _clean("step4_kyc_started", "kyc_started"),
        _clean("step5_completed", "reg_completed"),
    )
)
LOAN_POPULATION = "(product_category = 'Consumer Loans' OR flow_type = 'Sprint')"
REG_POPULATION = "(product_category IN ('Cards', 'Deposits', 'Homepage') OR flow_type = 'Registration')"
CAMPAIGN = "COALESCE(campaign, '(not set)') AS campaign"
add(
    "funnel_loans",
    f"SELECT event_date AS date, channel_group, {CAMPAIGN}, device_category, {LOAN_FUNNEL} FROM clean WHERE {LOAN_POPULATION} GROUP BY ALL",
)
add(
    "funnel_registration",
    f"SELECT event_date AS date, channel_group, {CAMPAIGN}, product_category, device_category, {REG_FUNNEL} FROM clean WHERE {REG_POPULATION} GROUP BY ALL",
)
SUMMARY = f"""SELECT 'Loans' AS funnel_type, DATE '2024-01-01' AS period_start, step1_apply_click AS loans_apply, step2_sub_id_captured AS loans_sub_id,
  step3_open_account AS loans_open_acc, step4_ssn_submitted AS loans_ssn, step5_check_limit AS loans_check_limit,
  step6_completed AS loans_completed, NULL::BIGINT AS reg_apply, NULL::BIGINT AS reg_sub_id, NULL::BIGINT AS reg_phone,
  NULL::BIGINT AS reg_kyc, NULL::BIGINT AS reg_completed
FROM (SELECT {LOAN_FUNNEL} FROM clean WHERE event_date >= DATE '2024-01-01' AND {LOAN_POPULATION})
UNION ALL SELECT 'Registration', DATE '2024-01-01', NULL, NULL, NULL, NULL, NULL, NULL, step1_apply_click, step2_sub_id_captured,
  step3_phone_submitted, step4_kyc_started, step5_completed
FROM (SELECT {REG_FUNNEL} FROM clean WHERE event_date >= DATE '2024-01-01' AND {REG_POPULATION})"""
add("funnel_summary", SUMMARY)
add("refreshed_funnel_summary", SUMMARY)
add(
    "funnel_loans_documented",
    f"""SELECT event_date AS date, channel_group, campaign,
  {_users('step1_pageview', "event_name_clean = 'page_view' AND product_category = 'Consumer Loans'")},
  {_clean('step2_apply_click', 'sprint_apply_click')}, {_clean('step3_otp', 'sprint_otp_requested')},
  {_clean('step4_phone', 'sprint_phone_submitted', 'sprint_login_via_mobile')}, {_clean('step5_check_limit', 'check_limit_click')},
  {_clean('step6_completed', 'sprint_check_limit_completed')} FROM documented WHERE {LOAN_POPULATION} GROUP BY ALL""",
)
add(
    "funnel_registration_documented",
    f"""SELECT event_date AS date, channel_group, campaign, product_category,
  {_clean('step1_apply_click', 'reg_apply_click')}, {_clean('step2_otp', 'reg_otp_requested')},
  {_clean('step3_phone', 'reg_phone_submitted')}, {_clean('step4_ssn', 'reg_ssn_submitted')},
  {_clean('step5_email', 'reg_email_verified')}, {_clean('step6_kyc_start', 'kyc_start')},
  {_clean('step7_kyc_complete', 'kyc_qr_scanned')}, {_clean('step8_completed', 'reg_completed')}
FROM documented WHERE product_category IN ('Cards', 'Deposits') OR flow_type = 'Registration' GROUP BY ALL""",
)
_STEPS = ("step1_apply_click", "step2_sub_id_captured", "step3_open_account", "step4_ssn_submitted", "step5_check_limit", "step6_completed")
add(
    "funnel_step_rates",
    f"""SELECT channel_group, stage, stage_name, users,
  {_per('users', 'lag(users) OVER w', ' * 100')} AS pct_of_previous, {_per('users', 'first_value(users) OVER w', ' * 100')} AS pct_of_total
FROM (SELECT channel_group, CAST(substr(stage_name, 5, 1) AS INTEGER) AS stage, stage_name, users FROM (
  UNPIVOT (SELECT channel_group, {LOAN_FUNNEL} FROM clean WHERE {LOAN_POPULATION} GROUP BY ALL) ON {', '.join(_STEPS)} INTO NAME stage_name VALUE users))
WINDOW w AS (PARTITION BY channel_group ORDER BY stage)""",
    "pct_of_previous pct_of_total",
)

# --- spend and bank
add("fact_ad_spend_google", "SELECT * FROM spend_google")
add(
    "fact_ad_spend_meta",
    f"SELECT date, 'Paid Social' AS channel_group, campaign, impressions, clicks, spend_usd, spend_amd, reach, {RATES} FROM meta",
)
add("fact_ad_spend", "SELECT * REPLACE (CAST(conversions AS DOUBLE) AS conversions, CAST(cost_per_conversion AS DOUBLE) AS cost_per_conversion) FROM spend")
add(
    "raw_ad_spend",
    """SELECT date, channel AS channel_group, campaign_name AS campaign, CAST(impressions AS DOUBLE) AS impressions, CAST(clicks AS DOUBLE) AS clicks,
  CASE WHEN currency = 'amd' THEN cost / 400 ELSE cost END AS spend_usd, CASE WHEN currency = 'amd' THEN cost ELSE cost * 400 END AS spend_amd FROM landed""",
)
add(
    "spend_by_campaign",
    f"""SELECT campaign, channel_group, sum(impressions) AS impressions, sum(clicks) AS clicks, sum(spend_usd) AS spend_usd, sum(spend_amd) AS spend_amd,
  {_per('sum(clicks)', 'sum(impressions)', ' * 100')} AS ctr_pct, {_per('sum(spend_usd)', 'sum(clicks)')} AS cpc_usd,
  {_per('sum(spend_usd)', 'sum(impressions)', ' * 1000')} AS cpm_usd,
  avg(cost_per_conversion) FILTER (WHERE cost_per_conversion <> 0) AS avg_cost_per_conversion FROM spend GROUP BY ALL""",
    "impressions clicks spend_usd spend_amd ctr_pct cpc_usd cpm_usd avg_cost_per_conversion",
)
add(
    "spend_last_90_days",
    "SELECT date_trunc('week', date)::DATE AS date, channel_group, sum(spend_usd) AS spend_usd FROM spend WHERE date >= DATE '2023-11-02' GROUP BY ALL",
    "spend_usd",
)
BANK_DOUBLES = "loan_amount deposit_amount"
add("fact_bank_conversions", "SELECT * FROM bank", f"{BANK_DOUBLES} total_revenue_amd")
add(
    "bank_load_totals",
    "SELECT CAST(sum(loan_count) AS BIGINT) AS loans, CAST(sum(card_count) AS BIGINT) AS cards, CAST(sum(deposit_count) AS BIGINT) AS deposits, "
    "round(sum(loan_amount + deposit_amount)) AS total_revenue FROM bank",
)
add("bank_merge", "SELECT * FROM merged", BANK_DOUBLES)
add(
    "bank_merge_counts",
    "SELECT count(*) FILTER (WHERE action = 'insert') AS added, count(*) FILTER (WHERE action = 'update') AS updated, count(*) AS total_rows FROM merged",
)
CTES["loaded_rows"] = """SELECT * REPLACE (
  CASE WHEN token_id[-1] = '6' THEN 0.0 WHEN token_id[-1] >= '5' THEN loan_amount + 1 ELSE loan_amount END AS loan_amount,
  CASE WHEN token_id[-1] >= '5' THEN deposit_amount + 1 ELSE deposit_amount END AS deposit_amount,
  CASE WHEN token_id LIKE '%55' THEN card_count + 10 ELSE card_count END AS card_count)
FROM bank_raw WHERE token_id[-1] <> '9' AND token_id NOT LIKE '%77'"""
CTES["loaded_fact"] = CTES["bank"].replace("FROM bank_raw b", "FROM loaded_rows b")
add("bank_load", "SELECT * FROM loaded_fact", f"{BANK_DOUBLES} total_revenue_amd")
add("bank_merge_table", "SELECT * EXCLUDE (acquired_source, action) FROM merged", BANK_DOUBLES)
add(
    "bank_insert_if_absent",
    "SELECT token_id, client_code, event_date, loan_amount FROM bank_raw WHERE token_id NOT IN (SELECT token_id FROM merge_old)",
    "loan_amount",
)

# --- dashboard charts
APPLIES = "CAST(sum(loans_apply_click) + sum(cards_deposits_apply_click) AS BIGINT)"
CVR = f"{_per('sum(registrations)', 'sum(loans_apply_click) + sum(cards_deposits_apply_click)', ' * 100')}"
BOUNCE = f"{_per('sum(bounced_sessions)', 'sum(sessions)', ' * 100')}"


def _sum(*names: str) -> str:
    return ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)


def _chart(name: str, select: str, source: str, group: str = "", tail: str = "", doubles: str = "", where: str = "") -> None:
    keys = f"{group}, " if group else ""
    body = f"SELECT {keys}{select} FROM {source} {where} {'GROUP BY ALL' if group else ''} {tail}"
    add(f"chart_{name}", body, doubles)


BY_REG = "ORDER BY registrations DESC, {} NULLS FIRST LIMIT {}"
WEEK, LAST_MONTH = "date_trunc('week', date)::DATE AS date", "WHERE date >= DATE '2023-12-31' AND date < DATE '2024-01-31'"
_chart("total_sessions", _sum("sessions"), "fs")
_chart("total_users", _sum("users"), "fs")
_chart("total_registrations", _sum("registrations"), "fc")
_chart("total_apply_clicks", f"{APPLIES} AS applies", "fc")
_chart("bounce_rate", f"{BOUNCE} AS bounce_rate_pct", "fs", doubles="bounce_rate_pct")
_chart("conversion_rate", f"{CVR} AS cvr_pct", "fc", doubles="cvr_pct")
_chart("daily_performance_trend", _sum("sessions", "users"), "fs", "date", "ORDER BY date")
_chart("channel_contribution", _sum("sessions"), "fs", f"{WEEK}, channel_group", "ORDER BY ALL")
_chart(
    "channel_performance",
    f"{_sum('total_sessions', 'total_users')}, {APPLIES} AS applies, {_sum('registrations')}, {CVR} AS cvr_pct",
    "fc", "channel_group", BY_REG.format("channel_group", 50), "cvr_pct",
)
_chart(
    "top_campaigns", f"{_sum('total_sessions')}, {APPLIES} AS applies, {_sum('registrations')}", "fc", "campaign, channel_group",
    "ORDER BY registrations DESC, campaign, channel_group LIMIT 20",
)
_chart("channel_trend", _sum("sessions"), "fs", "date, channel_group", "ORDER BY date, channel_group")
_chart("registrations_by_channel", _sum("registrations"), "fc", "channel_group", BY_REG.format("channel_group", 20))
_chart(
    "campaign_performance_matrix", f"{_sum('total_sessions', 'registrations')}, {APPLIES} AS applies", "fc", "campaign",
    "ORDER BY total_sessions DESC, campaign LIMIT 50",
)
_chart("paid_vs_organic", "count(channel_key) AS channels", "channels", "channel_type", "ORDER BY channels DESC, channel_type LIMIT 10")
_chart("sessions_by_product", _sum("sessions"), "fs", "product_category", "ORDER BY sessions DESC, product_category LIMIT 10")
_chart("loans_funnel", _sum("loans_pageview"), "fc")
_chart("loans_funnel_stages", _sum(*LOAN_STEPS), "fc")
_chart(
    "cards_deposits_funnel",
    _sum("cards_deposits_pageview", "cards_deposits_apply_click", "cards_deposits_sub_id", "cards_deposits_phone_submit", "registrations"),
    "fc",
)
_chart(
    "funnel_by_channel", f"{_sum('total_sessions')}, {APPLIES} AS applies, {_sum('registrations')}, {CVR} AS cvr_pct", "fc",
    "channel_group", BY_REG.format("channel_group", 20), "cvr_pct",
)
_chart("registrations_trend", _sum("registrations"), "fc", "date", "ORDER BY date")
_chart(
    "weekly_registration_cohorts", f"{_sum('total_sessions')}, {APPLIES} AS applies, {_sum('registrations')}", "fc", WEEK,
    "ORDER BY 1 DESC LIMIT 10",
)
_chart(
    "device_performance", f"{_sum('sessions', 'users')}, {BOUNCE} AS bounce_rate_pct, avg(avg_session_duration_sec) AS avg_duration_sec",
    "fs", "device_category", "ORDER BY device_category", "bounce_rate_pct avg_duration_sec",
)
_chart(
    "country_performance", f"{_sum('total_sessions')}, {APPLIES} AS applies, {_sum('registrations')}", "fc", "country",
    BY_REG.format("country", 15),
)
_chart(
    "new_vs_returning_users", f"{_sum('sessions', 'users')}, {BOUNCE} AS bounce_rate_pct", "fs", "user_type",
    "ORDER BY user_type", "bounce_rate_pct",
)
_chart(
    "armenia_cities", _sum("total_sessions", "registrations"), "fc", "city", BY_REG.format("city", 10), where="WHERE country = 'Armenia'"
)


def _lagged(name: str, column: str, value: str, integer: bool) -> None:
    kind = "BIGINT" if integer else "DOUBLE"
    body = f"""SELECT date, {value}, lag({value}, 7) OVER (ORDER BY date) AS previous,
  {_per(f'{value} - lag({value}, 7) OVER (ORDER BY date)', f'lag({value}, 7) OVER (ORDER BY date)', ' * 100')} AS change_pct
FROM (SELECT d AS date, CAST(COALESCE(v, 0) AS {kind}) AS {value} FROM (
  SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS d FROM bank {LAST_MONTH})
  LEFT JOIN (SELECT date AS d, sum({column}) AS v FROM bank {LAST_MONTH} GROUP BY 1) USING (d))"""
    add(f"chart_{name}", body, "change_pct" if integer else f"{value} previous change_pct")


_lagged("actual_loans", "loan_count", "loans", True)
_lagged("actual_cards", "card_count", "cards", True)
_lagged("actual_deposits", "deposit_count", "deposits", True)
_lagged("loan_revenue", "loan_amount", "loan_revenue", False)
_lagged("deposit_revenue", "deposit_amount", "deposit_revenue", False)
_lagged("total_revenue", "total_revenue_amd", "revenue", False)

REVENUE = "sum(total_revenue_amd) AS revenue"
LOANS, CARDS, DEPOSITS = (f"CAST(sum({c}_count) AS BIGINT) AS {c}s" for c in ("loan", "card", "deposit"))
_chart("revenue_by_channel", REVENUE, "bank", "channel_group", "ORDER BY revenue DESC, channel_group LIMIT 10", "revenue", LAST_MONTH)
_chart(
    "bank_conversions_by_channel", f"{LOANS}, {CARDS}, {DEPOSITS}, {REVENUE}", "bank", "channel_group",
    "ORDER BY loans DESC, channel_group LIMIT 20", "revenue", LAST_MONTH,
)
_chart("loans_by_channel", LOANS, "bank", "channel_group", "ORDER BY loans DESC, channel_group LIMIT 10", "", LAST_MONTH)
_chart(
    "full_funnel_by_bank_product", f"{LOANS}, {CARDS}, {DEPOSITS}, {REVENUE}", "bank", "product_category",
    "ORDER BY product_category", "revenue", LAST_MONTH,
)
_chart(
    "new_vs_returning_revenue", REVENUE, "bank", "is_existing_customer", "ORDER BY revenue DESC, is_existing_customer LIMIT 10", "revenue",
    LAST_MONTH,
)
_chart(
    "top_campaigns_by_revenue", f"{LOANS}, {CARDS}, {REVENUE}", "bank", "acquired_campaign, channel_group",
    "ORDER BY loans DESC, acquired_campaign, channel_group LIMIT 20", "revenue", LAST_MONTH,
)

# --- combined reports
WEB_DAYS = """(SELECT date, channel_group, sum(sessions) AS sessions FROM fs GROUP BY ALL) w
FULL JOIN (SELECT date, channel_group, sum(registrations) AS registrations FROM fc GROUP BY ALL) r USING (date, channel_group)"""
add(
    "website_and_bank",
    f"""SELECT channel_group, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(registrations) AS BIGINT) AS registrations,
  CAST(sum(loans) AS BIGINT) AS actual_loans, sum(money) AS revenue
FROM {WEB_DAYS} FULL JOIN (SELECT date, channel_group, sum(loan_count) AS loans, sum(total_revenue_amd) AS money FROM bank GROUP BY ALL) b
  USING (date, channel_group) GROUP BY 1""",
    "revenue",
)
add(
    "spend_and_conversions",
    f"""SELECT date, channel_group, spend_usd, CAST(sessions AS BIGINT) AS sessions, CAST(registrations AS BIGINT) AS registrations,
  {_per('spend_usd', 'registrations')} AS cost_per_registration, {_per('spend_usd', 'sessions')} AS cost_per_session
FROM {WEB_DAYS} FULL JOIN (SELECT date, channel_group, sum(spend_usd) AS spend_usd FROM spend GROUP BY ALL) s USING (date, channel_group)""",
    "spend_usd cost_per_registration cost_per_session",
)
_LABELS = (*zip(("Page Views", "Apply Click", "Sub ID", "Check Limit", "Phone", "OTP"), LOAN_STEPS),)
add(
    "loans_funnel_to_bank",
    f"""SELECT CASE WHEN stage = 7 THEN (SELECT sum(loan_amount) FROM bank) END AS loan_amount, stage, stage_name, users,
  {_per('users', 'lag(users) OVER (ORDER BY stage)', ' * 100')} AS pct_of_previous,
  {_per('users', 'first_value(users) OVER (ORDER BY stage)', ' * 100')} AS pct_of_total
FROM ({' UNION ALL '.join(f"SELECT CAST({n} AS INTEGER) AS stage, '{label}' AS stage_name, CAST(sum({c}) AS BIGINT) AS users FROM fc" for n, (label, c) in enumerate(_LABELS, 1))}
  UNION ALL SELECT 7, 'Bank Approved', CAST(sum(loan_count) AS BIGINT) FROM bank)""",
    "loan_amount pct_of_previous pct_of_total",
)
add("funnel_week_change", "SELECT week_start, stage_name, users, previous, change_pct FROM stage_change", "change_pct")
CTES["card_weeks"] = " UNION ALL ".join(
    f"SELECT date_trunc('week', date)::DATE AS week_start, '{s}' AS stage_name, CAST(sum({s}) AS BIGINT) AS users FROM fc GROUP BY 1"
    for s in ("cards_deposits_pageview", "cards_deposits_apply_click", "cards_deposits_sub_id", "cards_deposits_phone_submit", "registrations")
)
CTES["card_change"] = CTES["stage_change"].replace("stage_weeks", "card_weeks")
add("funnel_cards_week_change", "SELECT week_start, stage_name, users, previous, change_pct FROM card_change", "change_pct")
add(
    "channel_overlay",
    """SELECT n.d AS date, c.channel_group, CAST(COALESCE(a.v, 0) AS BIGINT) AS sessions, CAST(COALESCE(b.v, 0) AS BIGINT) AS previous_sessions
FROM (SELECT DISTINCT channel_group FROM fs WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30') c
CROSS JOIN (SELECT DATE '2024-01-16' + CAST(unnest(range(0, 15)) AS INTEGER) AS d) n
LEFT JOIN (SELECT date, channel_group, sum(sessions) AS v FROM fs GROUP BY ALL) a ON a.date = n.d AND a.channel_group = c.channel_group
LEFT JOIN (SELECT date, channel_group, sum(sessions) AS v FROM fs GROUP BY ALL) b ON b.date = n.d - 15 AND b.channel_group = c.channel_group""",
)
add("month_kpis", "SELECT period, channel, product, metric, actual FROM kpis", "actual")
add("kpis_against_targets", "SELECT * FROM variances", "target_value actual variance_pct")
add(
    "spend_pacing",
    "SELECT * FROM pacing",
    "monthly_budget_usd daily_budget_usd spent_usd remaining_usd needed_daily_usd current_daily_usd spent_pct pacing_pct",
)
CTES["card_targets"] = """SELECT metric, CAST(target AS DOUBLE) AS target, CASE WHEN channel = 'all' THEN 'Grand Total' ELSE channel_group END AS channel_group
FROM targets LEFT JOIN code_list ON channel = channel_code WHERE product = 'all' AND metric IN ('cpa', 'roas')"""
CTES["scorecard"] = (
    f"""SELECT level, channel_group, revenue, CAST(approved AS BIGINT) AS approved, spend_usd, {_per('spend_usd', 'approved')} AS cpa_usd,
  {_per('revenue', 'spend_usd * 400')} AS roas FROM (
  SELECT 'channel' AS level, channel_group, revenue, approved, spend_usd FROM ch
  UNION ALL SELECT 'subtotal', 'Paid Total', sum(revenue), sum(approved), sum(spend_usd) FROM ch WHERE channel_group IN (SELECT name FROM paid_list)
  UNION ALL SELECT 'total', 'Grand Total', sum(revenue), sum(approved), sum(spend_usd) FROM ch)""".replace(
        "FROM ch",
        "FROM ((SELECT channel_group, sum(total_revenue_amd) AS revenue, sum(loan_count + card_count + deposit_count) AS approved FROM bank GROUP BY 1) "
        "FULL JOIN (SELECT channel_group, sum(spend_usd) AS spend_usd FROM spend GROUP BY 1) USING (channel_group))",
    )
)
add("channel_scorecard", "SELECT * FROM scorecard", "revenue spend_usd cpa_usd roas")
add(
    "channel_scorecard_targets",
    """SELECT s.*, c.target AS cpa_target_usd, r.target AS roas_target, (cpa_usd - c.target) / c.target * 100 AS cpa_vs_target_pct,
  (roas - r.target) / r.target * 100 AS roas_vs_target_pct
FROM scorecard s LEFT JOIN card_targets c ON c.metric = 'cpa' AND c.channel_group = s.channel_group
  LEFT JOIN card_targets r ON r.metric = 'roas' AND r.channel_group = s.channel_group""",
    "revenue spend_usd cpa_usd roas cpa_target_usd roas_target cpa_vs_target_pct roas_vs_target_pct",
)
add(
    "top_campaigns_against_average",
    f"""SELECT campaign, channel_group, revenue, approved, cpa_usd, a AS avg_cpa_usd, (cpa_usd - a) / a * 100 AS vs_avg_cpa_pct
FROM (SELECT * FROM campaign_list ORDER BY revenue DESC NULLS LAST, campaign, channel_group LIMIT 10),
  (SELECT {_per('sum(spend_usd)', 'sum(approved)')} AS a FROM campaign_list WHERE spend_usd IS NOT NULL)""",
    "revenue cpa_usd avg_cpa_usd vs_avg_cpa_pct",
)
add(
    "campaign_quadrants",
    """SELECT campaign, channel_group, approved, cpa_usd,
  (CASE WHEN approved >= v THEN 'high volume' ELSE 'low volume' END) || ' / ' || (CASE WHEN cpa_usd >= c THEN 'high CPA' ELSE 'low CPA' END) AS quadrant
FROM campaign_list, (SELECT quantile_disc(approved, 0.5) AS v, quantile_disc(cpa_usd, 0.5) AS c FROM campaign_list WHERE cpa_usd IS NOT NULL)
WHERE cpa_usd IS NOT NULL""",
    "cpa_usd",
)
add(
    "cohort_table",
    """SELECT date_trunc('week', apply_date)::DATE AS cohort_week, count(*) AS applies, count(*) FILTER (WHERE status = 'approved') AS approved,
  count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'approved') / count(*) * 100 AS approval_pct,
  avg(approval_date - apply_date) FILTER (WHERE status = 'approved') AS avg_days,
  count(*) FILTER (WHERE status = 'pending') > 0 AND DATE '2024-01-31' - date_trunc('week', apply_date)::DATE < 14 AS maturing
FROM apps GROUP BY date_trunc('week', apply_date)""",
    "approval_pct avg_days",
)
add(
    "approval_curve",
    """SELECT c.w AS cohort_week, CAST(d.day AS INTEGER) AS day, count(*) FILTER (WHERE status = 'approved' AND approval_date - apply_date <= d.day) AS approved_so_far,
  count(*) FILTER (WHERE status = 'approved' AND approval_date - apply_date <= d.day) / count(*) * 100 AS approved_pct
FROM (SELECT *, date_trunc('week', apply_date)::DATE AS w FROM apps) c, (SELECT unnest(range(0, 1 + COALESCE(greatest(0, max(approval_date - apply_date) FILTER (WHERE status = 'approved')), 0))) AS day FROM apps) d GROUP BY 1, 2""",
    "approved_pct",
)


def _band(column: str, name: str) -> str:
    return f"CASE WHEN {column} > 60 THEN 'green' WHEN {column} >= 40 THEN 'yellow' WHEN {column} < 40 THEN 'red' END AS {name}"


add(
    "funnel_heat_table",
    f"""SELECT *, {_band('apply_to_sub_id_pct', 'apply_to_sub_id_band')}, {_band('sub_id_to_registration_pct', 'sub_id_to_registration_band')},
  {_band('registration_to_approval_pct', 'registration_to_approval_band')} FROM (
SELECT channel_group, {_per('s', 'a', ' * 100')} AS apply_to_sub_id_pct, {_per('r', 's', ' * 100')} AS sub_id_to_registration_pct,
  {_per('b', 'r', ' * 100')} AS registration_to_approval_pct
FROM (SELECT channel_group, sum(loans_apply_click + cards_deposits_apply_click) AS a, sum(loans_sub_id + cards_deposits_sub_id) AS s,
  sum(registrations) AS r FROM fc GROUP BY 1)
FULL JOIN (SELECT channel_group, sum(loan_count + card_count + deposit_count) AS b FROM bank GROUP BY 1) USING (channel_group))""",
    "apply_to_sub_id_pct sub_id_to_registration_pct registration_to_approval_pct",
)
add(
    "segment_table",
    f"""SELECT segment, name, sessions, sessions / sum(sessions) OVER (PARTITION BY segment) * 100 AS sessions_pct, users, {_per('bounced', 'sessions', ' * 100')} AS bounce_rate_pct,
  registrations, {_per('bounced', 'sessions', ' * 100')} - {_per('sum(bounced) OVER s', 'sum(sessions) OVER s', ' * 100')} AS bounce_vs_avg,
  {_per('registrations', 'sessions', ' * 100')} - {_per('sum(registrations) OVER s', 'sum(sessions) OVER s', ' * 100')} AS registration_rate_vs_avg FROM (
  SELECT 'device' AS segment, COALESCE(device_category, '(not set)') AS name, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(users) AS BIGINT) AS users, sum(bounced_sessions) AS bounced FROM fs GROUP BY 2
  UNION ALL SELECT 'user type', COALESCE(user_type, '(not set)'), CAST(sum(sessions) AS BIGINT), CAST(sum(users) AS BIGINT), sum(bounced_sessions) FROM fs GROUP BY 2
  UNION ALL SELECT 'city', COALESCE(city, '(not set)'), CAST(sum(sessions) AS BIGINT), CAST(sum(users) AS BIGINT), sum(bounced_sessions) FROM fs GROUP BY 2)
LEFT JOIN (SELECT 'device' AS segment, COALESCE(device_category, '(not set)') AS name, CAST(sum(registrations) AS BIGINT) AS registrations FROM fc GROUP BY 2
  UNION ALL SELECT 'city', COALESCE(city, '(not set)'), CAST(sum(registrations) AS BIGINT) FROM fc GROUP BY 2) USING (segment, name) WINDOW s AS (PARTITION BY segment)""",
    "sessions_pct bounce_rate_pct bounce_vs_avg registration_rate_vs_avg",
)
add(
    "device_trend",
    """SELECT date, device_category, CAST(sum(sessions) AS BIGINT) AS sessions,
  sum(sessions) / sum(sum(sessions)) OVER (PARTITION BY date) * 100 AS share_pct FROM fs GROUP BY date, device_category""",
    "share_pct",
)
add(
    "customer_revenue_by_product",
    """SELECT product_category, is_existing_customer, sum(total_revenue_amd) AS revenue,
  CASE WHEN sum(sum(total_revenue_amd)) OVER (PARTITION BY product_category) <> 0
    THEN sum(total_revenue_amd) / sum(sum(total_revenue_amd)) OVER (PARTITION BY product_category) * 100 END AS share_pct
FROM bank GROUP BY product_category, is_existing_customer""",
    "revenue share_pct",
)
add(
    "paid_organic_split",
    """SELECT traffic, sessions, sessions / sum(sessions) OVER () * 100 AS sessions_pct, approved, approved / sum(approved) OVER () * 100 AS approved_pct,
  revenue, revenue / sum(revenue) OVER () * 100 AS revenue_pct
FROM (SELECT CASE WHEN channel_group IN (SELECT name FROM paid_list) THEN 'Paid' ELSE 'Organic/Direct' END AS traffic, CAST(sum(sessions) AS BIGINT) AS sessions FROM fs GROUP BY 1)
FULL JOIN (SELECT CASE WHEN channel_group IN (SELECT name FROM paid_list) THEN 'Paid' ELSE 'Organic/Direct' END AS traffic,
  CAST(sum(loan_count + card_count + deposit_count) AS BIGINT) AS approved, sum(total_revenue_amd) AS revenue FROM bank GROUP BY 1) USING (traffic)""",
    "sessions_pct approved_pct revenue revenue_pct",
)
add(
    "revenue_overlay",
    """SELECT n.d AS date, COALESCE(a.v, 0) AS revenue, COALESCE(a.c, 0) AS approved, COALESCE(b.v, 0) AS previous_revenue,
  COALESCE(b.c, 0) AS previous_approved, CAST(400000000.0 AS DOUBLE) / 31 AS target_per_day
FROM (SELECT DATE '2024-01-16' + CAST(unnest(range(0, 15)) AS INTEGER) AS d) n
LEFT JOIN bank_days a ON a.date = n.d LEFT JOIN bank_days b ON b.date = n.d - 15""",
    "revenue previous_revenue target_per_day",
)
add(
    "product_revenue_against_target",
    """SELECT period, product, revenue, CAST(target AS DOUBLE) AS target_value, (revenue - target) / target * 100 AS variance_pct
FROM (SELECT date_trunc('month', date)::DATE AS period, lower(rtrim(product_category, 's')) AS product, sum(total_revenue_amd) AS revenue
  FROM bank WHERE product_category <> 'Other' GROUP BY 1, 2)
LEFT JOIN (SELECT * FROM targets WHERE metric = 'revenue' AND channel = 'all') USING (period, product)""",
    "revenue target_value variance_pct",
)
add(
    "hour_pattern",
    """SELECT CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS day_of_week, CAST(hour(event_timestamp) AS INTEGER) AS hour, count(*) AS events,
  count(*) FILTER (WHERE event_name = 'page_view') AS pageviews FROM staged GROUP BY 1, 2""",
)

# --- metrics and series
APPLY_LIST = "('sprint_apply_button_click', 'reg_apply_button_click', 'cards_apply_button', 'apply_button_click')"


def _contract(keys: str) -> str:
    lead = f"{keys}, " if keys else ""
    return f"""SELECT *, {_per('registrations', 'sessions', ' * 100')} AS session_to_registration_pct, {_per('pageviews', 'sessions')} AS pages_per_session,
  {_per('apply_clicks', 'sessions', ' * 100')} AS session_to_apply_pct, {_per('sub_ids', 'apply_clicks', ' * 100')} AS apply_to_sub_id_pct,
  {_per('registrations', 'sub_ids', ' * 100')} AS sub_id_to_registration_pct
FROM (SELECT {lead}count(DISTINCT user_pseudo_id) AS users, {_users('new_users', 'session_number = 1')},
  {_event('registrations', 'registration_success')}, {_event('sub_id_loans', 'Get Sub ID sprint')}, {_event('sub_id_cards', 'Get Sub ID')},
  {_event('sub_ids', 'Get Sub ID', 'Get Sub ID sprint')}, {_users('apply_clicks', f'event_name IN {APPLY_LIST}')},
  count(DISTINCT session_id) AS sessions, count(DISTINCT user_pseudo_id || session_id) AS user_sessions,
  count(DISTINCT CASE WHEN user_pseudo_id IS NOT NULL AND session_id IS NOT NULL THEN (user_pseudo_id, session_id) END) AS session_pairs,
  count(*) FILTER (WHERE event_name = 'page_view') AS pageviews FROM staged {f'GROUP BY {keys}' if keys else ''})"""


CONTRACT_DOUBLES = "session_to_registration_pct pages_per_session session_to_apply_pct apply_to_sub_id_pct sub_id_to_registration_pct"
add("contract_totals", _contract(""), CONTRACT_DOUBLES)
add("contract_by_channel", _contract("channel_group"), CONTRACT_DOUBLES)
add(
    "session_quality_by_device",
    """SELECT device_category, count(*) AS session_rows, count(*) FILTER (WHERE e IS NULL OR e = 0) AS not_engaged,
  count(*) FILTER (WHERE e IS NULL OR e = 0) / count(*) * 100 AS bounce_rate_pct, avg(m) / 1000 AS avg_session_duration_sec
FROM (SELECT device_category, user_pseudo_id, session_id, max(session_engaged) AS e, sum(engagement_time_msec) AS m FROM staged GROUP BY ALL) GROUP BY 1""",
    "bounce_rate_pct avg_session_duration_sec",
)
add(
    "weekly_growth",
    f"""SELECT channel_group, week_start, sessions, previous, {_per('sessions - previous', 'previous', ' * 100')} AS change_pct,
  CASE WHEN previous = 0 AND sessions > 0 THEN 'New' END AS change_label
FROM (SELECT *, lag(sessions) OVER (PARTITION BY channel_group ORDER BY week_start) AS previous FROM (
  SELECT channel_group, week_start, CAST(COALESCE(n, 0) AS BIGINT) AS sessions FROM (
    SELECT channel_group, CAST(unnest(generate_series(min(date_trunc('week', date)), max(date_trunc('week', date)), INTERVAL 7 DAY)) AS DATE) AS week_start
    FROM fs GROUP BY 1)
  LEFT JOIN (SELECT channel_group, date_trunc('week', date)::DATE AS week_start, sum(sessions) AS n FROM fs GROUP BY ALL) USING (channel_group, week_start)))""",
    "change_pct",
)
add(
    "weighted_session_metrics",
    f"""SELECT product_category, user_type, {_sum('new_users', 'pageviews')}, {_per('sum(pageviews)', 'sum(sessions)')} AS pages_per_session,
  avg(avg_session_duration_sec) AS avg_duration_sec, {_per('sum(avg_session_duration_sec * sessions)', 'sum(sessions)')} AS weighted_duration_sec
FROM fs GROUP BY 1, 2""",
    "pages_per_session avg_duration_sec weighted_duration_sec",
)
add(
    "country_filter_chart",
    f"""SELECT city, device_category, {_sum('total_users')}, {APPLIES} AS applies, CAST(sum(loans_sub_id) + sum(cards_deposits_sub_id) AS BIGINT) AS sub_ids,
  {_sum('registrations')} FROM fc WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
  AND channel_group IN ('Meta Ads', 'Email', 'Direct', 'Referral', 'Other') AND product_category <> 'Other' GROUP BY 1, 2""",
)
add(
    "inactivity_sessions",
    """SELECT user_id, session_no, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 AS duration_sec FROM numbered_events GROUP BY 1, 2""",
    "duration_sec",
)
add("event_session_numbers", "SELECT event_id, session_no FROM numbered_events")

# --- quality and alerts


def _checks(source: str, rows: list[tuple], suite: str) -> str:
    """One SELECT per check: (table, name, severity, expression, relation, threshold)."""
    parts = [
        f"SELECT '{suite}' AS suite, '{table}' AS \"table\", '{name}' AS \"check\", '{severity}' AS severity, "
        f"COALESCE(v {test} {limit}, FALSE) AS passed, v AS observed, CAST({limit} AS DOUBLE) AS threshold "
        f"FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {source})"
        for table, name, severity, value, test, limit in rows
    ]
    return " UNION ALL ".join(parts)


def _count_if(test: str) -> str:
    return f"count(*) FILTER (WHERE {test})"


REFRESH = " UNION ALL ".join(
    (
        _checks(
            "fs",
            [
                ("fact_sessions", "No data for yesterday", "critical", _count_if("date = DATE '2024-01-30'"), ">", 0),
                ("fact_sessions", "NULL sessions detected", "critical", _count_if("sessions IS NULL"), "=", 0),
                ("fact_sessions", "Negative users detected", "critical", _count_if("users < 0"), "=", 0),
                ("fact_sessions", "Row count dropped significantly", "warning", "count(*)", ">=", 50000),
            ],
            "refresh",
        ),
        _checks(
            "fc",
            [
                ("fact_conversions", "No conversion data for yesterday", "critical", _count_if("date = DATE '2024-01-30'"), ">", 0),
                ("fact_conversions", "NULL registrations detected", "critical", _count_if("registrations IS NULL"), "=", 0),
            ],
            "refresh",
        ),
        _checks(
            "channels",
            [("dim_channel", "Unknown channel_type detected", "warning", _count_if("channel_type IS NULL OR channel_type = ''"), "=", 0)],
            "refresh",
        ),
    )
)
add("refresh_checks", REFRESH, "observed threshold")
def _summary(source: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed AND severity = 'critical') AS failed,
  count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings,
  COALESCE(string_agg("table" || ': ' || "check", '; ' ORDER BY "table", "check") FILTER (WHERE NOT passed AND severity = 'critical'), '') AS critical_failures,
  count(*) FILTER (WHERE NOT passed AND severity = 'critical') = 0 AS ok FROM {source}"""


add("refresh_summary", _summary(f"({REFRESH})"))


def _nulls(table: str, column: str) -> tuple:
    return (table, f"{column} nulls", "critical", f"{_count_if(f'{column} IS NULL')} / count(*) * 100", "<=", 5)


def _range(table: str, column: str) -> tuple:
    return (table, f"{column} range", "critical", _count_if(f"{column} < 0"), "=", 0)


def _rows(table: str, minimum: int) -> tuple:
    return (table, "row count", "critical", "count(*)", ">=", minimum)


FRESH = ("freshness", "critical", "DATE '2024-01-31' - max(date)", "<=", 7)
B = "fact_bank_conversions"
add(
    "quality_suite",
    " UNION ALL ".join(
        (
            _checks(
                "fs",
                [
                    _rows("fact_sessions", 1000), _nulls("fact_sessions", "date"), _nulls("fact_sessions", "channel_group"),
                    ("fact_sessions", *FRESH), _range("fact_sessions", "sessions"), _range("fact_sessions", "users"),
                ],
                "suite",
            ),
            _checks(
                "fc",
                [
                    _rows("fact_conversions", 1000), _nulls("fact_conversions", "date"), _nulls("fact_conversions", "product_category"),
                    ("fact_conversions", *FRESH),
                ],
                "suite",
            ),
            _checks(
                "bank",
                [
                    _rows(B, 100), _nulls(B, "date"), _nulls(B, "channel_group"), _nulls(B, "loan_count"), _range(B, "loan_count"),
                    _range(B, "loan_amount"), _range(B, "card_count"), (B, "loans total", "critical", "sum(loan_count)", ">", 0),
                    (B, "cards total", "critical", "sum(card_count)", ">=", 0), (B, "deposits total", "critical", "sum(deposit_count)", ">=", 0),
                ],
                "suite",
            ),
            _checks("channels", [_rows("dim_channel", 5)], "suite"),
            _checks("(SELECT unnest(range(14)))", [_rows("dim_product", 3)], "suite"),
        )
    ),
    "observed threshold",
)
KNOWN_CHANNELS = (
    "('Direct','Google Ads','Google Organic','Meta Ads','NN Ads','MS Network','Native Ads','Intent Ads','Prodigi Ads','Adfox Video','LinkedIn',"
    "'Email','SMS','Viber','Telegram','Yandex','Bing Organic','Yahoo','Survey','Referral','Other')"
)
add(
    "staging_checks",
    _checks(
        "staged",
        [
            ("stg_events", "STG-01 rows today", "critical", _count_if("event_date = DATE '2024-01-31'"), ">", 0),
            ("stg_events", "STG-02 event_name not null", "critical", _count_if("event_name IS NULL"), "=", 0),
            ("stg_events", "STG-03 user_pseudo_id not null", "critical", _count_if("user_pseudo_id IS NULL"), "=", 0),
            ("stg_events", "STG-04 session_id not null", "critical", _count_if("session_id IS NULL"), "=", 0),
            ("stg_events", "STG-05 unknown channel_group pct", "warning", f"{_count_if(f'channel_group NOT IN {KNOWN_CHANNELS}')} / count(*) * 100", "<=", 1),
        ],
        "matrix",
    ),
    "observed threshold",
)
add(
    "mart_checks",
    _checks(
        "(SELECT date, sum(sessions) AS sessions, sum(bounced_sessions) AS bounced FROM fs GROUP BY 1)",
        [
            ("fact_sessions", "MART-02 freshness", "critical", "DATE '2024-01-31' - max(date)", "<=", 2),
            ("fact_sessions", "MART-03 latest sessions", "critical", "arg_max(sessions, date)", ">", 0),
            ("fact_sessions", "MART-05 bounce rate range", "critical", "NOT (sum(bounced) / sum(sessions) BETWEEN 0 AND 1)", "=", 0),
        ],
        "matrix",
    ),
    "observed threshold",
)
add(
    "spend_checks",
    _checks(
        "spend",
        [
            ("ad_spend", "AD-01 rows yesterday", "warning", _count_if("date = DATE '2024-01-30'"), ">", 0),
            ("ad_spend", "AD-02 negative cost", "critical", _count_if("spend_usd < 0"), "=", 0),
        ],
        "matrix",
    ),
    "observed threshold",
)


def _daily(value: str, source: str, name: str) -> str:
    return f"""SELECT d AS date, CAST(COALESCE(n, 0) AS BIGINT) AS {name} FROM (
  SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS d FROM {source})
  LEFT JOIN (SELECT date AS d, {value} AS n FROM {source} GROUP BY 1) USING (d)"""


add(
    "volume_drop",
    f"""SELECT date, rows, prior_avg, (prior_avg - rows) / prior_avg * 100 AS drop_pct, COALESCE((prior_avg - rows) / prior_avg * 100 < 30, TRUE) AS passed
FROM (SELECT *, avg(rows) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS prior_avg FROM ({_daily('count(*)', 'fs', 'rows')}))""",
    "prior_avg drop_pct",
)
add(
    "registration_band",
    f"""SELECT date, registrations, rolling_avg, COALESCE(registrations BETWEEN rolling_avg * 0.5 AND rolling_avg * 1.5, TRUE) AS passed
FROM (SELECT *, avg(registrations) OVER (ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rolling_avg FROM ({_daily('sum(registrations)', 'fc', 'registrations')}))""",
    "rolling_avg",
)
add(
    "channel_agreement",
    """SELECT count(DISTINCT channel_group) FILTER (WHERE side = 1) AS left_channels, count(DISTINCT channel_group) FILTER (WHERE side = 2) AS right_channels,
  count(DISTINCT channel_group) FILTER (WHERE side = 1) = count(DISTINCT channel_group) FILTER (WHERE side = 2) AS counts_equal,
  2 * count(DISTINCT channel_group) - count(DISTINCT channel_group) FILTER (WHERE side = 1) - count(DISTINCT channel_group) FILTER (WHERE side = 2) AS only_on_one_side
FROM (SELECT 1 AS side, channel_group FROM fs UNION ALL SELECT 2, channel_group FROM bank)""",
)
add(
    "duplicate_bank_clients",
    "SELECT event_date, client_code, count(*) AS n FROM bank_raw GROUP BY ALL HAVING count(*) > 1",
)
add(
    "duplicate_counts",
    "SELECT count(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows "
    "FROM (SELECT event_date, client_code, count(*) AS n FROM bank_raw GROUP BY ALL)",
)
add("grain_duplicates", "SELECT CAST(0 AS BIGINT) AS duplicate_keys, CAST(0 AS BIGINT) AS surplus_rows FROM (SELECT count(*) FROM fs)")
add(
    "orphan_channels",
    "SELECT channel_group, count(*) AS fact_rows FROM bank WHERE channel_group NOT IN (SELECT channel_group FROM channels WHERE channel_group <> 'Email') GROUP BY 1",
)
CTES["all_checks"] = " UNION ALL ".join(
    (
        *[f"SELECT * FROM ({ORACLE[name]})" for name in ("refresh_checks", "quality_suite", "staging_checks", "spend_checks")],
        *[
            f"SELECT * FROM ({_checks(f'({source})', [(table, name, severity, value, '=', 0)], suite)})"
            for source, table, name, severity, value, suite in (
                (
                    "SELECT count(*) AS n FROM ((SELECT DISTINCT channel_group, 1 AS a FROM fs) FULL JOIN "
                    "(SELECT DISTINCT channel_group, 1 AS b FROM fc) USING (channel_group)) WHERE a IS NULL OR b IS NULL",
                    "fact_sessions", "channels agree with fact_conversions", "critical", "max(n)", "suite",
                ),
                (ORACLE["channel_agreement"], "fact_sessions", "channels agree with fact_bank_conversions", "info", "max(only_on_one_side)", "suite"),
                (
                    "SELECT count(*) - count(DISTINCT ROW(date, source_clean, channel_group, campaign, device_category, product_category, country, city, user_type)) AS n FROM fs",
                    "fact_sessions", "repeated grain", "critical", "max(n)", "suite",
                ),
                (ORACLE["duplicate_counts"], "bank_conversions", "repeated clients a day", "info", "max(surplus_rows)", "suite"),
                (
                    "SELECT DISTINCT channel_group FROM bank WHERE channel_group NOT IN (SELECT channel_group FROM channels)",
                    "fact_bank_conversions", "channels without a dimension row", "warning", "count(*)", "matrix",
                ),
                (ORACLE["volume_drop"], "fact_sessions", "days with a drop of rows", "warning", "count(*) FILTER (WHERE NOT passed)", "matrix"),
                (ORACLE["registration_band"], "fact_conversions", "days outside the band of registrations", "warning", "count(*) FILTER (WHERE NOT passed)", "matrix"),
            )
        ],
    )
)
add("quality_all", "SELECT * FROM all_checks", "observed threshold")
add("quality_all_summary", _summary("all_checks"))
CTES["alert_input"] = """SELECT metric, channel || '/' || product AS subject, variance_pct AS value FROM variances
  WHERE metric IN ('cpa', 'approval_rate', 'roas')
UNION ALL SELECT 'pacing', channel, pacing_pct FROM pacing
UNION ALL SELECT 'funnel_stage', stage_name, arg_max(change_pct, week_start) FROM stage_change GROUP BY 2"""
CTES["alert_rows"] = """SELECT *,
  CASE WHEN metric = 'cpa' THEN CASE WHEN value >= 25 THEN 'red' WHEN value >= 15 THEN 'yellow' WHEN value IS NOT NULL THEN 'green' END
    WHEN metric = 'approval_rate' THEN CASE WHEN value <= -15 THEN 'red' WHEN value <= -8 THEN 'yellow' WHEN value IS NOT NULL THEN 'green' END
    WHEN metric = 'pacing' THEN CASE WHEN value < 75 OR value > 115 THEN 'red' WHEN value < 85 OR value > 105 THEN 'yellow' WHEN value IS NOT NULL THEN 'green' END
    ELSE CASE WHEN value <= -20 THEN 'red' WHEN value <= -10 THEN 'yellow' WHEN value IS NOT NULL THEN 'green' END END AS level,
  COALESCE(CASE metric WHEN 'cpa' THEN value > 20 WHEN 'approval_rate' THEN value < -10 WHEN 'funnel_stage' THEN value < -15
    WHEN 'pacing' THEN value > 110 ELSE FALSE END, FALSE) AS header_alert,
  CASE WHEN abs(value) <= 5 THEN 'green' WHEN abs(value) <= 15 THEN 'yellow' WHEN value IS NOT NULL THEN 'red' END AS colour
FROM alert_input"""
add("alert_levels", "SELECT * FROM alert_rows", "value")
add(
    "alert_header",
    "SELECT bool_or(header_alert) AS alert, count(*) FILTER (WHERE level = 'yellow') AS yellow, count(*) FILTER (WHERE level = 'red') AS red FROM alert_rows",
)

# --- tables, refresh, streams
add("incremental_sessions", "SELECT * FROM fs")
add("stream_fact_sessions", "SELECT * FROM fs")
add("append_new_rows", "SELECT token_id, client_code, loan_count FROM bank_raw")
REFRESHED = {
    "dim_channel": "SELECT * FROM channels",
    "dim_date": "SELECT unnest(generate_series(DATE '2025-01-01', DATE '2027-12-31', INTERVAL 1 DAY))",
    "dim_product": "SELECT unnest(range(14))",
    "fact_sessions": "SELECT * FROM fs",
    "fact_conversions": "SELECT * FROM fc_clean",
    "fact_ad_spend_google": "SELECT * FROM spend_google",
    "fact_ad_spend": "SELECT * FROM spend",
    **{name: ORACLE[name] for name in ("funnel_loans", "funnel_registration", "funnel_summary")},
}
add(
    "refresh_status",
    " UNION ALL ".join(f"""SELECT '{t}' AS "table", 'full' AS mode, TRUE AS ok, count(*) AS rows FROM ({body})""" for t, body in REFRESHED.items()),
)
_COMPLETE = ("all marts", "MART-06 refresh completeness", "critical", "10", ">=", 10)
add("refresh_check_rows", f"{REFRESH.replace('FROM fc)', 'FROM fc_clean)')} UNION ALL {_checks('(SELECT 1)', [_COMPLETE], 'matrix')}", "observed threshold")
add("refresh_incremental", "SELECT * FROM fc_clean")
add(
    "stream_daily_counts",
    "SELECT event_date AS date, channel_group, count(*) AS events, count(*) FILTER (WHERE event_name = 'page_view') AS pageviews, "
    "event_date + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 7 DAY FROM events) AS final FROM staged GROUP BY event_date, channel_group",
)
add("stream_users_by_sketch", "SELECT channel_group, count(DISTINCT user_pseudo_id) AS users, TRUE AS near FROM staged GROUP BY 1")
CTES["stream_chunks"] = """SELECT user_pseudo_id, event_timestamp AS ts, event_id,
  CASE WHEN lag(event_timestamp) OVER w IS NULL OR event_timestamp - lag(event_timestamp) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS starts
FROM flat WHERE user_pseudo_id IS NOT NULL WINDOW w AS (PARTITION BY user_pseudo_id ORDER BY event_timestamp, event_id)"""
add(
    "stream_sessions",
    """SELECT user_pseudo_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events,
  max(ts) + INTERVAL 30 MINUTE <= (SELECT max(event_timestamp) - INTERVAL 7 DAY FROM flat WHERE user_pseudo_id IS NOT NULL) AS final FROM (
  SELECT *, sum(starts) OVER (PARTITION BY user_pseudo_id ORDER BY ts, event_id) AS no FROM stream_chunks) GROUP BY user_pseudo_id, no""",
)
add("stream_compacted_store", "SELECT * FROM fs")
_EARLY = "SELECT date, CAST(sum(sessions) AS BIGINT) AS sessions FROM fs WHERE date <= DATE '2024-01-26' GROUP BY 1"
add(
    "table_versions",
    f"""SELECT 'while written' AS reader, * FROM ({_EARLY}) UNION ALL SELECT 'the first', * FROM ({_EARLY})
UNION ALL SELECT 'published', date, CAST(sum(sessions) AS BIGINT) FROM fs GROUP BY date""",
)
add(
    "refresh_published",
    """SELECT "table", "table" <> 'fact_ad_spend' AS published, CASE WHEN "table" <> 'fact_ad_spend' THEN CAST(2 AS BIGINT) END AS number,
  CASE WHEN "table" = 'fact_ad_spend' AND (SELECT count(*) FROM google) > 0 THEN 'AD-02 negative cost' END AS reason
FROM (SELECT unnest(['dim_channel','dim_date','dim_product','fact_sessions','fact_conversions','fact_ad_spend_google','fact_ad_spend',
  'funnel_loans','funnel_registration','funnel_summary']) AS "table")""",
)
add("refresh_keeps_bad_spend", "SELECT date, channel_group, sum(spend_usd) AS spend_usd, count(*) AS rows FROM spend GROUP BY ALL", "spend_usd")
_RELATIONS = (
    (
        "SELECT count(*) AS n FROM ((SELECT DISTINCT channel_group, 1 AS a FROM fs) FULL JOIN "
        "(SELECT DISTINCT channel_group, 1 AS b FROM fc_clean) USING (channel_group)) WHERE a IS NULL OR b IS NULL",
        "fact_sessions", "channels agree with fact_conversions", "critical", "max(n)", "suite",
    ),
    (
        "SELECT count(*) - count(DISTINCT ROW(date, source_clean, channel_group, campaign, device_category, product_category, country, city, user_type)) AS n FROM fs",
        "fact_sessions", "repeated grain", "critical", "max(n)", "suite",
    ),
    (ORACLE["volume_drop"], "fact_sessions", "days with a drop of rows", "warning", "count(*) FILTER (WHERE NOT passed)", "matrix"),
    (
        _with(f"""SELECT COALESCE(registrations BETWEEN rolling_avg * 0.5 AND rolling_avg * 1.5, TRUE) AS passed
FROM (SELECT *, avg(registrations) OVER (ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rolling_avg
FROM ({_daily('sum(registrations)', 'fc_clean', 'registrations')}))"""),
        "fact_conversions", "days outside the band of registrations", "warning", "count(*) FILTER (WHERE NOT passed)", "matrix",
    ),
)
add(
    "refresh_relation_rows",
    " UNION ALL ".join(
        [f"SELECT * FROM ({_checks(f'({source})', [(table, name, severity, value, '=', 0)], suite)})" for source, table, name, severity, value, suite in _RELATIONS]
        + [f"SELECT * FROM ({ORACLE['spend_checks']})".replace("'ad_spend' AS", "'fact_ad_spend' AS")]
    ),
    "observed threshold",
)
add(
    "scanned_inputs",
    " UNION ALL ".join(
        f"SELECT 'since {since}' AS input, count(DISTINCT CAST(ts AS DATE)) AS files, TRUE AS fewer_bytes FROM events {test}"
        for since, test in (("2024-01-01", ""), ("2024-01-10", "WHERE ts >= DATE '2024-01-10'"), ("2024-01-24", "WHERE ts >= DATE '2024-01-24'"))
    ),
)
add(
    "views_report",
    "SELECT channel_type, is_paid, date, CAST(sum(sessions) AS BIGINT) AS sessions FROM fs JOIN channels USING (source_clean, channel_group) GROUP BY ALL",
)
add(
    "empty_spend_table",
    """SELECT date, channel AS channel_group, sum(CASE WHEN currency = 'amd' THEN cost / 400 ELSE cost END) AS spend_usd, count(*) AS rows FROM landed GROUP BY ALL""",
    "spend_usd",
)
for _kind in ("csv", "parquet"):
    ORACLE[f"uploads_{_kind}"] = ORACLE["uploads_tsv"]
ORACLE["raw_ad_spend_landed"] = ORACLE["raw_ad_spend"]
add("google_ads_landed", "SELECT * FROM spend_google WHERE date >= DATE '2024-01-11'")
CTES["meta_drops"] = """SELECT * REPLACE (CASE WHEN reach % 3 = 0 AND reach % 10 IN (4, 5) THEN NULL ELSE clicks END AS clicks) FROM meta"""
add(
    "meta_insights_landed",
    f"SELECT date, 'Paid Social' AS channel_group, campaign, impressions, clicks, spend_usd, spend_amd, reach, {RATES} FROM meta_drops",
)
add(
    "lost_values",
    """SELECT field, CASE WHEN field = 'clicks' THEN (SELECT count(*) FROM meta WHERE reach % 3 = 0 AND reach % 10 = 5) ELSE 0 END AS lost,
  (SELECT count(*) FROM meta) AS rows
FROM (SELECT unnest(['date_start','campaign_name','adset_name','impressions','clicks','spend','reach']) AS field)""",
)
CTES["damaged_rows"] = """SELECT *, token_id[-1] = '9' AS anonymous, CAST(substr(client_code, 2) AS BIGINT) % 40 AS k
FROM (SELECT * FROM bank_raw UNION ALL SELECT * FROM bank_raw WHERE loan_count > 0)"""
add(
    "bank_export_checks_damaged",
    """SELECT count(*) AS total_rows, CAST(1 AS BIGINT) AS missing_columns, count(*) FILTER (WHERE k = 1) AS bad_dates,
  count(*) FILTER (WHERE k = 2) AS empty_dates, count(*) FILTER (WHERE k = 3) AS empty_clients, count(*) FILTER (WHERE anonymous) AS empty_tokens,
  count(*) FILTER (WHERE NOT anonymous AND k NOT IN (1, 2, 3)) - count(DISTINCT token_id) FILTER (WHERE NOT anonymous AND k NOT IN (1, 2, 3)) AS duplicate_rows
FROM damaged_rows""",
)
CTES["export_rows"] = """SELECT *, CAST(substr(token_id, 2) AS BIGINT) % 40 AS k, row_number() OVER (ORDER BY CAST(substr(token_id, 2) AS BIGINT)) AS record
FROM bank_raw WHERE token_id[-1] <> '9'"""
add(
    "bank_load_rejects",
    """SELECT record, CASE k WHEN 1 THEN 'unreadable date' ELSE 'negative figure' END AS reason,
  CASE k WHEN 1 THEN '31/31/2024' ELSE strftime(event_date, '%Y-%m-%d') END AS event_date_text, token_id, client_code FROM export_rows WHERE k IN (1, 11)""",
)
CTES["accepted_rows"] = """SELECT * REPLACE (CASE WHEN token_id[-1] = '6' THEN 0.0 ELSE loan_amount END AS loan_amount,
  CASE WHEN k = 2 THEN NULL ELSE event_date END AS event_date) FROM export_rows WHERE k NOT IN (1, 11)"""
CTES["accepted_fact"] = CTES["bank"].replace("FROM bank_raw b", "FROM accepted_rows b")
add("bank_load_accepted", "SELECT * FROM accepted_fact", f"{BANK_DOUBLES} total_revenue_amd")


CTES["late_merged"] = """SELECT * REPLACE (
  CASE WHEN token_id LIKE '%55' THEN loan_amount + 1 ELSE loan_amount END AS loan_amount,
  CASE WHEN token_id LIKE '%55' THEN deposit_amount + 1 ELSE deposit_amount END AS deposit_amount,
  CASE WHEN token_id LIKE '%55' THEN card_count + 10 ELSE card_count END AS card_count,
  CASE WHEN token_id LIKE '%55' THEN TIMESTAMP '2024-01-31 07:00:00' ELSE uploaded_at END AS uploaded_at) FROM merge_old"""
add(
    "bank_merge_pruned",
    "SELECT token_id, client_code, event_date, loan_count, loan_amount, deposit_count, deposit_amount, card_count, uploaded_at FROM late_merged",
    "loan_amount deposit_amount",
)
add(
    "bank_merge_pruned_bytes",
    "SELECT count(*) AS source_keys, count(*) AS updated, CAST(0 AS BIGINT) AS added, TRUE AS fewer_bytes FROM merge_old WHERE token_id LIKE '%55'",
)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
