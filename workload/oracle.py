"""The queries as plain SQL over the given tables.

The source tables come from the same projections the Spark side reads
(``SOURCE_SQL``); everything built on them is written anew here, and what the
Spark side reads from XML is taken from the columns the XML was made of.
"""

from __future__ import annotations

from kontor.sources.retail import GIVEN_TABLES, SOURCE_SQL

# Monday first; January first.
DAY_NAMES = {
    "spanish": ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"],
    "french": ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"],
}
MONTH_NAMES = {
    "spanish": [
        "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
        "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
    ],
    "french": [
        "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
        "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
    ],
}

# Columns of the profiled tables, and whether they are numbers.
PROFILED = {
    "orders": {"o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": True,
               "o_orderdate": False, "o_orderpriority": False},
    "customer": {"c_custkey": True, "c_name": False, "c_nationkey": True, "c_acctbal": True, "c_mktsegment": False},
    "lineitem": {"l_orderkey": True, "l_partkey": True, "l_suppkey": True, "l_linenumber": True, "l_quantity": True,
                 "l_extendedprice": True, "l_discount": True, "l_tax": True, "l_returnflag": False,
                 "l_linestatus": False, "l_shipdate": False},
}
_HALFWAY = "TIMESTAMP '1998-01-01 00:00:00'"

# Customers whose survey is well-formed.
_SURVEYED = "c_acctbal >= 0 AND NOT (c_mktsegment = 'MACHINERY' AND c_acctbal > 9000)"

_INCOME = """CASE WHEN c_nationkey = 0 THEN NULL WHEN c_acctbal < 2500 THEN 12500.0
  WHEN c_acctbal < 5000 THEN 37500.5 WHEN c_acctbal < 7500 THEN 62500.5
  WHEN c_acctbal < 9000 THEN 87500.5 ELSE 130000.0 END"""

_CODE = """CASE WHEN s_acctbal < 2500 THEN 'OS' WHEN s_acctbal < 5000 THEN 'BS'
  WHEN s_acctbal < 7500 THEN 'BM' ELSE 'ZZ' END"""
_TYPE_OF_CODE = """CASE code WHEN 'OS' THEN 'Warehouse' WHEN 'BS' THEN 'Specialty Bike Shop'
  WHEN 'BM' THEN 'Value Added Reseller' ELSE code END"""
_RHYTHM_OF_CODE = "CASE code WHEN 'OS' THEN 'Q' WHEN 'BS' THEN 'A' WHEN 'BM' THEN 'S' END"


def _currency_key(code: str) -> str:
    """A number for a code of three letters."""
    return " + ".join(
        f"ascii(substring({code}, {at}, 1)) * {256 ** (3 - at)}" for at in (1, 2, 3)
    )


def _key(moment: str) -> str:
    return f"CAST(strftime({moment}, '%Y%m%d') AS INT)"


_LINE_NUMBER = """row_number() OVER (PARTITION BY h.salesordernumber ORDER BY
    p.productnumber NULLS LAST, d.specialofferid NULLS LAST, d.orderqty, d.unitprice,
    d.unitpricediscount, d.linetotal, d.carriertrackingnumber NULLS LAST, {fan_out})"""

_AMOUNTS = f"""d.orderqty AS orderquantity, CAST(d.unitprice AS DOUBLE) AS unitprice,
  CAST(d.linetotal AS DOUBLE) AS extendedamount,
  CAST(d.unitpricediscount AS DOUBLE) AS unitpricediscountpct,
  CAST(CAST(d.unitprice * d.orderqty * d.unitpricediscount AS DECIMAL(19,4)) AS DOUBLE) AS discountamount,
  CAST(p.standardcost AS DOUBLE) AS productstandardcost,
  CAST(p.standardcost * d.orderqty AS DOUBLE) AS totalproductcost,
  CAST(d.linetotal AS DOUBLE) AS salesamount, d.linetotal AS exact_amount,
  CAST(h.taxamt AS DOUBLE) AS taxamt, CAST(h.freight AS DOUBLE) AS freight,
  d.carriertrackingnumber, h.purchaseordernumber AS customerponumber,
  h.orderdate, h.duedate, h.shipdate, '2026-01-01' AS saved"""

_KEYS = f"""p.productid + 1 AS productkey, {_key('h.orderdate')} AS orderdatekey,
  {_key('h.duedate')} AS duedatekey, {_key('h.shipdate')} AS shipdatekey,
  d.specialofferid + 1 AS promotionkey, {_currency_key("coalesce(r.tocurrencycode, 'USD')")} AS currencykey,
  h.territoryid + 1 AS salesterritorykey, h.salesordernumber"""

# Building blocks: name -> (blocks and source tables it reads, SQL).
_BLOCKS: dict[str, tuple[list[str], str]] = {
    "internet": (["salesorderheader", "salesorderdetail", "product", "currencyrate"], f"""
SELECT {_KEYS}, c.c_custkey + 1 AS customerkey, 1 AS revisionnumber,
  {_LINE_NUMBER.format(fan_out='1')} AS salesorderlinenumber, {_AMOUNTS}
FROM src_salesorderheader h
JOIN src_salesorderdetail d ON h.salesorderid = d.salesorderid
LEFT JOIN src_product p ON d.productid = p.productid
LEFT JOIN src_currencyrate r ON h.currencyrateid = r.currencyrateid
LEFT JOIN customer c ON h.customerid = c.c_custkey AND c_acctbal >= 0 AND c.c_nationkey <> 3
QUALIFY shipdatekey IS NOT NULL AND customerkey IS NOT NULL AND productkey IS NOT NULL"""),
    "resold": (["salesorderheader", "salesorderdetail", "product", "currencyrate", "customer", "employee"], f"""
SELECT {_KEYS}, CAST(substring(a.accountnumber, 3) AS BIGINT) + 1 AS resellerkey,
  CAST(substring(e.nationalidnumber, 4) AS BIGINT) + 1 AS employeekey,
  CASE WHEN h.revisionnumber = 8 THEN 1 ELSE 2 END AS revisionnumber,
  {_LINE_NUMBER.format(fan_out='a.accountnumber NULLS LAST')} AS salesorderlinenumber, {_AMOUNTS}
FROM src_salesorderdetail d
JOIN src_salesorderheader h ON d.salesorderid = h.salesorderid
JOIN src_customer c ON h.customerid = c.customerid AND c.personid IS NOT NULL
JOIN src_employee e ON h.salespersonid = e.businessentityid
JOIN src_product p ON d.productid = p.productid
LEFT JOIN src_currencyrate r ON h.currencyrateid = r.currencyrateid
LEFT JOIN src_customer a ON c.storeid = a.storeid AND a.personid IS NULL
QUALIFY resellerkey IS NOT NULL"""),
    "sold": ([], """
SELECT o_orderdate, o_orderstatus, o_orderpriority, o_custkey, l_discount,
  CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_quantity AS INT)
    * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(19,4)) AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "quarter_region": (["sold"], """
SELECT year(o_orderdate) AS "año", quarter(o_orderdate) AS trimestre, r_name AS region_mundo,
  CAST(sum(amount) AS DOUBLE) AS total_ventas
FROM sold JOIN nation ON o_custkey % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE o_orderstatus <> 'P' GROUP BY ALL"""),
    "by_month": (["sold"], """
SELECT year(o_orderdate) AS "año", month(o_orderdate) AS mes, monthname(o_orderdate) AS nombre_mes,
  sum(amount) AS exact
FROM sold WHERE o_orderstatus <> 'P' GROUP BY ALL"""),
    "by_channel": (["sold"], """
SELECT 'Internet' AS canal, CAST(sum(amount) AS DOUBLE) AS total_ventas FROM sold WHERE o_orderstatus <> 'P'
UNION ALL
SELECT 'Tiendas/Reseller', CAST(sum(amount) AS DOUBLE) FROM sold WHERE o_orderpriority <> '5-LOW'"""),
    "by_promotion": (["sold"], """
SELECT 'Offer ' || id AS promocion,
  CASE WHEN id = 0 THEN 'No Discount' WHEN id < 6 THEN 'Volume' ELSE 'Season' END AS tipo,
  CASE WHEN id < 4 THEN 'Customer' ELSE 'Reseller' END AS categoria,
  CAST(sum(amount) AS DOUBLE) AS total_ventas
FROM (SELECT CAST(round(l_discount * 100) AS INT) AS id, amount FROM sold WHERE o_orderpriority <> '5-LOW')
GROUP BY ALL"""),
    "by_store": (["sold"], """
SELECT year(o_orderdate) AS "año", quarter(o_orderdate) AS trimestre, monthname(o_orderdate) AS mes,
  month(o_orderdate) AS monthnumberofyear, s_name AS tienda, sum(amount) AS exact
FROM sold JOIN supplier ON o_custkey // 15 = s_suppkey WHERE o_orderpriority <> '5-LOW' GROUP BY ALL"""),
    "best_stores": (["by_store"], """
SELECT tienda, sum(exact) AS exact,
  row_number() OVER (ORDER BY sum(exact) DESC, tienda) AS place
FROM by_store GROUP BY tienda"""),
    "best_quarters": (["by_store", "best_stores"], """
SELECT "año", trimestre, tienda, place, "año" || '-Q' || trimestre AS periodo,
  CAST(sum(b.exact) AS DOUBLE) AS total_ventas
FROM by_store b JOIN best_stores s USING (tienda) WHERE place <= 5 GROUP BY ALL"""),
    "words": ([], """
SELECT DISTINCT w FROM (SELECT p_name AS w FROM part UNION ALL SELECT p_type FROM part)
WHERE w LIKE '%l%' OR w LIKE '%L%'"""),
    "product_rows": (["product", "productsubcategory"], """
SELECT name AS englishproductname, productnumber AS productalternatekey,
  CAST(listprice AS DOUBLE) AS listprice, coalesce(color, 'NA') AS color, size,
  CAST(weight AS DOUBLE) AS weight, weightunitmeasurecode, sizeunitmeasurecode,
  CAST(standardcost AS DOUBLE) AS standardcost, finishedgoodsflag, safetystocklevel,
  reorderpoint, daystomanufacture, productline, class, style,
  CAST(sellstartdate AS TIMESTAMP) AS startdate, CAST(sellenddate AS TIMESTAMP) AS enddate,
  s.productsubcategoryid AS productsubcategorykey, 'NA' AS sizerange, 'NA' AS modelname,
  CASE WHEN sellenddate IS NULL THEN 'Current' ELSE 'Discontinued' END AS status
FROM src_product p LEFT JOIN (SELECT productsubcategoryid FROM src_productsubcategory) s
  ON p.productsubcategoryid = s.productsubcategoryid"""),
    "geography": (["address", "stateprovince", "countryregion", "salesterritory"], """
SELECT city, stateprovincecode, s.name AS stateprovincename, s.countryregioncode,
  r.name AS englishcountryregionname, postalcode, s.territoryid AS salesterritorykey,
  r.name AS spanishcountryregionname, r.name AS frenchcountryregionname, 'NA' AS ipaddresslocator
FROM src_address a JOIN src_stateprovince s USING (stateprovinceid)
JOIN src_countryregion r ON s.countryregioncode = r.countryregioncode
JOIN src_salesterritory t ON s.territoryid = t.territoryid"""),
    "employee_rows": (["employee", "person", "emailaddress", "personphone", "salesperson", "employeepayhistory", "employeedepartmenthistory", "department"], """
SELECT CAST(NULL AS BIGINT) AS parentemployeekey,
  CAST(NULL AS VARCHAR) AS parentemployeenationalidalternatekey,
  s.territoryid + 1 AS salesterritorykey, p.firstname, p.lastname, p.middlename,
  coalesce(p.namestyle, false) AS namestyle, e.jobtitle AS title,
  TRY_CAST(e.hiredate AS TIMESTAMP) AS hiredate, CAST(e.birthdate AS TIMESTAMP) AS birthdate,
  e.loginid, m.emailaddress, f.phonenumber AS phone, e.maritalstatus,
  coalesce(p.firstname, '') || ' ' || coalesce(p.lastname, '') AS emergencycontactname,
  f.phonenumber AS emergencycontactphone, e.salariedflag, e.gender, y.payfrequency,
  CAST(y.rate AS DOUBLE) AS baserate, e.vacationhours, e.sickleavehours,
  e.salariedflag IS NOT NULL AS currentflag, s.businessentityid IS NOT NULL AS salespersonflag,
  d.name AS departmentname, CAST(h.startdate AS TIMESTAMP) AS startdate,
  CAST(h.enddate AS TIMESTAMP) AS enddate,
  CASE WHEN h.enddate IS NOT NULL THEN 'Current' END AS status,
  CAST(NULL AS VARCHAR) AS employeephoto, e.nationalidnumber AS employeenationalidalternatekey
FROM src_employee e
LEFT JOIN src_person p ON e.businessentityid = p.businessentityid
LEFT JOIN src_emailaddress m ON p.businessentityid = m.businessentityid
LEFT JOIN src_personphone f ON p.businessentityid = f.businessentityid
LEFT JOIN src_salesperson s ON e.businessentityid = s.businessentityid
LEFT JOIN src_employeepayhistory y ON e.businessentityid = y.businessentityid
LEFT JOIN src_employeedepartmenthistory h ON e.businessentityid = h.businessentityid
LEFT JOIN src_department d ON h.departmentid = d.departmentid"""),
    "store_fields": ([], f"""
SELECT s_suppkey, s_name, valid,
  CASE WHEN valid THEN 1100.5 + s_nationkey END AS annualrevenue,
  CASE WHEN valid AND s_nationkey <> 2 THEN 1980 + s_nationkey END AS yearopened,
  CASE WHEN valid THEN 'Bank of ' || s_nationkey || ' & Co' END AS bankname,
  CASE WHEN valid THEN s_acctbal END AS annualsales,
  CASE WHEN valid THEN s_nationkey END AS numberemployees,
  CASE WHEN valid THEN CASE WHEN s_nationkey < 12 THEN 'Road' ELSE 'Touring' END END AS productline,
  CASE WHEN valid THEN {_CODE} END AS code
FROM (SELECT *, s_acctbal >= 0 AND s_nationkey <> 1 AS valid FROM supplier)"""),
    "order_years": (["salesorderheader", "customer"], """
SELECT storeid, month(max(orderdate)) AS ordermonth, year(min(orderdate)) AS firstorderyear,
  year(max(orderdate)) AS lastorderyear
FROM src_salesorderheader JOIN src_customer USING (customerid) GROUP BY storeid"""),
    "reseller_rows": (["customer", "store", "businessentityaddress", "address", "businessentitycontact", "personphone", "store_fields", "order_years"], f"""
WITH ranked AS (
  SELECT c.storeid, c.accountnumber, a.addressline1, a.addressline2, p.phonenumber, a.city, a.postalcode,
    row_number() OVER (PARTITION BY c.accountnumber ORDER BY c.modifieddate, a.addressline1 NULLS LAST,
      a.addressline2 NULLS LAST, p.phonenumber NULLS LAST) AS rn
  FROM src_customer c
  LEFT JOIN src_store s ON c.storeid = s.businessentityid
  LEFT JOIN src_businessentityaddress b ON s.businessentityid = b.businessentityid
  LEFT JOIN src_address a ON b.addressid = a.addressid
  LEFT JOIN src_businessentitycontact k ON s.businessentityid = k.businessentityid
  LEFT JOIN src_personphone p ON k.personid = p.businessentityid
  WHERE c.personid IS NULL)
SELECT CAST(substring(city, 6) AS BIGINT) * 10 + CAST(substring(postalcode, 2) AS BIGINT) AS geographykey,
  accountnumber AS reselleralternatekey, phonenumber AS phone, {_TYPE_OF_CODE} AS businesstype,
  s_name AS resellername, numberemployees, {_RHYTHM_OF_CODE} AS orderfrequency, ordermonth,
  firstorderyear, lastorderyear, productline, addressline1, addressline2, annualsales, bankname,
  CAST(NULL AS VARCHAR) AS minpaymenttype, CAST(NULL AS DOUBLE) AS minpaymentamount,
  CAST(annualrevenue AS DOUBLE) AS annualrevenue, yearopened
FROM ranked r LEFT JOIN store_fields ON r.storeid = s_suppkey
LEFT JOIN order_years o ON r.storeid = o.storeid WHERE rn = 1"""),
    "promotion_rows": (["specialoffer"], """
SELECT specialofferid AS promotionalternatekey, description AS englishpromotionname,
  CAST(discountpct AS DOUBLE) AS discountpct, type AS englishpromotiontype,
  category AS englishpromotioncategory, CAST(startdate AS TIMESTAMP) AS startdate,
  CAST(enddate AS TIMESTAMP) AS enddate, minqty, maxqty, description AS spanishpromotionname,
  description AS frenchpromotionname, type AS spanishpromotiontype, type AS frenchpromotiontype,
  category AS spanishpromotioncategory, category AS frenchpromotioncategory
FROM src_specialoffer"""),
    "territory_rows": (["salesterritory"], """
SELECT territoryid AS salesterritoryalternatekey, name AS salesterritoryregion,
  countryregioncode AS salesterritorycountry, territorygroup AS salesterritorygroup
FROM src_salesterritory"""),
    "calendar": ([], f"""
SELECT {_key('day')} AS datekey, day AS fulldatealternatekey, isodow(day) AS daynumberofweek,
  dayname(day) AS englishdaynameofweek,
  {DAY_NAMES['spanish']}[isodow(day)] AS spanishdaynameofweek,
  {DAY_NAMES['french']}[isodow(day)] AS frenchdaynameofweek,
  day(day) AS daynumberofmonth, dayofyear(day) AS daynumberofyear, week(day) AS weeknumberofyear,
  monthname(day) AS englishmonthname, {MONTH_NAMES['spanish']}[month(day)] AS spanishmonthname,
  {MONTH_NAMES['french']}[month(day)] AS frenchmonthname, month(day) AS monthnumberofyear,
  quarter(day) AS calendarquarter, year(day) AS calendaryear,
  CASE WHEN quarter(day) <= 2 THEN 1 ELSE 2 END AS calendarsemester,
  quarter(day) AS fiscalquarter, year(day) AS fiscalyear,
  CASE WHEN quarter(day) <= 2 THEN 1 ELSE 2 END AS fiscalsemester
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day FROM orders)"""),
    "survey_fields": ([], f"""
SELECT c_custkey * 2 AS businessentityid,
  CASE WHEN ok THEN CAST(DATE '1960-01-01' + c_nationkey * 365 AS VARCHAR) || 'Z' END AS birthdate,
  CASE WHEN ok THEN CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'M' ELSE 'S' END END AS maritalstatus,
  CASE WHEN ok THEN CASE WHEN c_nationkey = 0 THEN 'unknown' WHEN c_acctbal < 2500 THEN '0-25000'
    WHEN c_acctbal < 5000 THEN '25001-50000' WHEN c_acctbal < 7500 THEN '$50,001-75000'
    WHEN c_acctbal < 9000 THEN '75001-100000' ELSE 'Greater than 100000' END END AS yearlyincome,
  CASE WHEN ok THEN CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END END AS gender,
  CASE WHEN ok AND c_nationkey <> 3 THEN '2' END AS totalchildren,
  CASE WHEN ok THEN '1' END AS numberchildrenathome,
  CASE WHEN ok THEN c_mktsegment END AS englisheducation,
  CASE WHEN ok THEN '' END AS englishoccupation, CASE WHEN ok THEN '1' END AS houseownerflag,
  CASE WHEN ok THEN CAST(c_nationkey AS VARCHAR) END AS numbercarsowned,
  CASE WHEN ok AND c_nationkey >= 5 THEN '2-5 Miles' END AS commutedistance,
  CASE WHEN ok THEN '2001-07-22Z' END AS datefirstpurchase,
  CAST(CASE WHEN ok THEN {_INCOME} END AS DOUBLE) AS income
FROM (SELECT *, {_SURVEYED} AS ok FROM customer)"""),
}


def _with(body: str, *needs: str) -> str:
    """``body`` behind the blocks and source tables it needs."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        if name in _BLOCKS:
            used, text = _BLOCKS[name]
            for one in used:
                add(one)
            parts.setdefault(name, text)
        else:
            given = {table: table for table in GIVEN_TABLES}
            parts.setdefault(f"src_{name}", SOURCE_SQL[name].format(**given))

    for need in needs:
        add(need)
    if not parts:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts.items()) + "\n" + body


def _translated(column: str, what: str) -> str:
    """Spanish and French versions of ``column`` by the word list."""
    listed = f"{column} IN (SELECT w FROM words)"
    return (
        f"CASE WHEN {listed} THEN 'es ' || {column} ELSE {column} END AS spanish{what}, "
        f"CASE WHEN {listed} AND {column} NOT LIKE '%bolt%' THEN 'fr ' || {column} "
        f"ELSE {column} END AS french{what}"
    )


def _columns(block: str, *names: str) -> str:
    return _with(f"SELECT {', '.join(names) or '*'} FROM {block}", block)


def _first_of_two(rows: str, name: str, key: str, *more: str) -> str:
    """Every row and its older name under one key: the one that comes first by name."""
    return f"""SELECT {', '.join(['*', *more])} FROM (
  SELECT * FROM {rows} UNION ALL BY NAME
  SELECT * REPLACE ('N older ' || {name} AS {name}) FROM {rows})
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {name} NULLS LAST) = 1"""


_FACT = """orderdatekey, duedatekey, shipdatekey, promotionkey, currencykey, salesterritorykey,
  salesordernumber, salesorderlinenumber, revisionnumber, orderquantity, unitprice, extendedamount,
  unitpricediscountpct, discountamount, productstandardcost, totalproductcost, salesamount, taxamt,
  freight, carriertrackingnumber, customerponumber, orderdate, duedate, shipdate, saved"""
_FACT_COLUMNS = "productkey, " + _FACT


def oracle_sql() -> dict[str, str]:
    lines = "l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax"
    return {
        "sales_by_quarter_region": _columns("quarter_region"),
        "second_quarters_by_region": _with(
            "SELECT * FROM quarter_region WHERE trimestre = 2", "quarter_region"),
        "sales_pivot_region": _with(
            'SELECT "año", trimestre, ' + ", ".join(
                f"max(total_ventas) FILTER (region_mundo = '{name}') AS \"{name}\""
                for name in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
            ) + " FROM quarter_region GROUP BY ALL", "quarter_region"),
        "region_values": _with("SELECT DISTINCT region_mundo FROM quarter_region", "quarter_region"),
        "region_trend": _columns(
            "quarter_region", "region_mundo", "\"año\" || '-Q' || trimestre AS periodo", "total_ventas"),
        "sales_by_month": _columns(
            "by_month", '"año"', "mes", "nombre_mes", "CAST(exact AS DOUBLE) AS total_ventas"),
        "month_trend": _columns(
            "by_month", "\"año\" || '-' || nombre_mes AS periodo", "CAST(exact AS DOUBLE) AS total_ventas"),
        "sales_by_month_all_years": _with(
            "SELECT mes, nombre_mes, CAST(sum(exact) AS DOUBLE) AS total_ventas FROM by_month GROUP BY ALL",
            "by_month"),
        "sales_by_channel": _columns("by_channel"),
        "channel_share": _columns(
            "by_channel", "*", "round(total_ventas * 100 / sum(total_ventas) OVER (), 1) AS porcentaje"),
        "promotions_by_sales": _columns("by_promotion"),
        "top10_promotions": _with(
            "SELECT * FROM by_promotion ORDER BY total_ventas DESC, promocion, tipo, categoria LIMIT 10",
            "by_promotion"),
        "store_sales_month": _columns(
            "by_store", '"año"', "trimestre", "mes", "monthnumberofyear", "tienda",
            "CAST(exact AS DOUBLE) AS total_ventas"),
        "store_preview": _with(
            'SELECT "año", trimestre, mes, monthnumberofyear, tienda, CAST(exact AS DOUBLE) AS total_ventas '
            'FROM by_store ORDER BY "año", trimestre, monthnumberofyear, exact DESC, tienda LIMIT 5', "by_store"),
        "top5_stores": _with(
            "SELECT tienda, CAST(exact AS DOUBLE) AS total_ventas FROM best_stores WHERE place <= 5",
            "best_stores"),
        "top5_store_quarters": _columns(
            "best_quarters", '"año"', "trimestre", "tienda", "periodo", "total_ventas"),
        "store_quarter_pivot": _with(
            'SELECT "año", trimestre, periodo, ' + ", ".join(
                f"coalesce(max(total_ventas) FILTER (place = {n}), 0) AS top{n}" for n in range(1, 6)
            ) + " FROM best_quarters GROUP BY ALL", "best_quarters"),
        "dim_date": _columns("calendar"),
        "dim_product_category": _with(
            "SELECT productcategoryid AS productcategoryalternatekey, name AS englishproductcategoryname, "
            + _translated("name", "productcategoryname") + " FROM src_productcategory",
            "productcategory", "words"),
        "dim_product_subcategory": _with(
            "SELECT productsubcategoryid AS productsubcategoryalternatekey, "
            "name AS englishproductsubcategoryname, productcategoryid AS productcategorykey, "
            + _translated("name", "productsubcategoryname") + " FROM src_productsubcategory",
            "productsubcategory", "words"),
        "dim_product": _with(
            "SELECT *, " + _translated("englishproductname", "productname") + " FROM product_rows",
            "product_rows", "words"),
        "dim_currency": _with(
            "SELECT currencycode AS currencyalternatekey, name AS currencyname FROM src_currency", "currency"),
        "dim_promotion": _columns("promotion_rows"),
        "dim_sales_reason": _with(
            "SELECT salesreasonid AS salesreasonalternatekey, coalesce(name, 'NA') AS salesreasonname, "
            "coalesce(reasontype, 'NA') AS salesreasonreasontype FROM src_salesreason", "salesreason"),
        "dim_sales_territory": _columns("territory_rows"),
        "dim_geography": _columns("geography"),
        "dim_employee": _columns("employee_rows"),
        "latest_employees": _with("""
SELECT * FROM employee_rows QUALIFY row_number() OVER (PARTITION BY employeenationalidalternatekey
  ORDER BY payfrequency DESC NULLS LAST) = 1""", "employee_rows"),
        "dim_customer": _with("""
SELECT c.accountnumber AS customeralternatekey, c.territoryid AS geographykey, p.namestyle, p.title,
  p.firstname, p.middlename, p.lastname, p.suffix, m.emailaddress, a.addressline1, a.addressline2,
  f.birthdate, f.maritalstatus, f.income AS yearlyincome, f.gender, f.totalchildren,
  f.numberchildrenathome, f.englisheducation, f.englishoccupation, f.houseownerflag,
  f.numbercarsowned, f.commutedistance, f.datefirstpurchase, f.englisheducation AS spanisheducation,
  f.englisheducation AS frencheducation, f.englishoccupation AS spanishoccupation,
  f.englishoccupation AS frenchoccupation
FROM src_customer c JOIN src_person p ON c.personid = p.businessentityid
JOIN survey_fields f ON p.businessentityid = f.businessentityid
LEFT JOIN src_emailaddress m ON p.businessentityid = m.businessentityid
LEFT JOIN src_address a ON a.addressid = c.customerid
WHERE f.totalchildren IS NOT NULL""", "customer", "person", "emailaddress", "address", "survey_fields"),
        "dim_reseller": _columns("reseller_rows"),
        "first_last_order_year": _columns("order_years"),
        "fact_internet_sales": _columns("internet", "customerkey", _FACT_COLUMNS),
        "fact_reseller_sales": _columns("resold", "resellerkey", "employeekey", _FACT_COLUMNS),
        "fact_internet_sales_bucketed": _columns("internet", "customerkey", _FACT_COLUMNS),
        "fact_reseller_sales_bucketed": _columns("resold", "resellerkey", "employeekey", _FACT_COLUMNS),
        "fact_internet_sales_since": _columns("internet", "customerkey", _FACT_COLUMNS)
        + f" WHERE orderdate >= {_HALFWAY}",
        "fact_reseller_sales_since": _columns("resold", "resellerkey", "employeekey", _FACT_COLUMNS)
        + f" WHERE orderdate >= {_HALFWAY}",
        "fact_sales_reason": _with("""
SELECT h.salesordernumber, CASE WHEN s.salesreasonid < 6 THEN s.salesreasonid + 1 END AS salesreasonkey,
  '2026-01-01' AS saved, CASE WHEN s.salesreasonid < 6
    THEN row_number() OVER (PARTITION BY h.salesordernumber, s.salesreasonid) END AS salesorderlinenumber
FROM src_salesorderheader h JOIN lineitem ON h.salesorderid = l_orderkey
JOIN src_salesorderheadersalesreason b ON h.salesorderid = b.salesorderid
JOIN src_salesreason s ON b.salesreasonid = s.salesreasonid""",
            "salesorderheader", "salesorderheadersalesreason", "salesreason"),
        "fact_survey_response": _with(f"""
SELECT DISTINCT {_key('h.orderdate')} AS datekey, c_custkey + 1 AS customerkey,
  t.productcategoryid + 1 AS productcategorykey, t.name AS englishproductcategoryname,
  s.productsubcategoryid + 1 AS productsubcategorykey, s.name AS englishproductsubcategoryname,
  h.orderdate AS date
FROM src_salesorderheader h JOIN src_salesorderdetail d ON h.salesorderid = d.salesorderid
JOIN src_product p ON d.productid = p.productid
JOIN src_productsubcategory s ON p.productsubcategoryid = s.productsubcategoryid
JOIN src_productcategory t ON s.productcategoryid = t.productcategoryid
JOIN customer ON h.customerid = c_custkey
WHERE c_acctbal >= 0 AND c_nationkey <> 3""",
            "salesorderheader", "salesorderdetail", "product", "productsubcategory", "productcategory"),
        "fact_sales_quota": f"""
SELECT s_suppkey + 1 AS employeekey, {_key('ts')} AS datekey, year(ts) AS calendaryear,
  quarter(ts) AS calendarquarter, CAST(CAST(value AS DECIMAL(15,2)) AS DOUBLE) AS salesamountquota,
  ts AS date
FROM events JOIN supplier ON user_id = s_suppkey""",
        "dim_department": _with("""
SELECT 1 AS departmentgroupkey, CAST(NULL AS BIGINT) AS parentdepartmentgroupkey,
  'Corporate' AS departmentgroupname
UNION ALL
SELECT 1 + row_number() OVER (ORDER BY groupname), 1, groupname
FROM (SELECT DISTINCT groupname FROM src_department)""", "department"),
        "dim_organization": _with(f"""
, divisions AS (
  SELECT row_number() OVER (ORDER BY t.name, t.territorygroup, t.countryregioncode) AS k, t.name,
    (SELECT min(currencycode) FROM src_countryregioncurrency y
     WHERE y.countryregioncode = t.countryregioncode) AS code
  FROM (SELECT DISTINCT name, territorygroup, countryregioncode FROM src_salesterritory) t)
SELECT k AS organizationkey, CAST(NULL AS BIGINT) AS parentorganizationkey,
  name || ' Division' AS organizationname,
  CASE WHEN code IN (SELECT currencycode FROM src_currency) THEN {_currency_key('code')} END AS currencykey,
  length(name) / 100.0 AS percentageofownership
FROM divisions
UNION ALL
SELECT k + (SELECT count(*) FROM divisions), k, name, NULL, NULL FROM divisions""",
            "salesterritory", "countryregioncurrency", "currency").replace("\n\n, divisions", ",\ndivisions"),
        "loaded_quarter_region": _with(f"""
SELECT year(orderdate) AS "año", quarter(orderdate) AS trimestre, r_name AS region_mundo,
  CAST(sum(exact_amount) AS DOUBLE) AS total_ventas
FROM internet JOIN customer ON customerkey = c_custkey + 1
JOIN nation ON salesterritorykey = n_nationkey + 1 JOIN region ON n_regionkey = r_regionkey
WHERE {_SURVEYED} GROUP BY ALL""", "internet"),
        "loaded_reseller_mart": _with("""
SELECT 'RS' || (resellerkey - 1) AS reselleralternatekey, s_name AS resellername,
  CAST(sum(posts) AS BIGINT) AS line_count, CAST(sum(exact_amount * posts) AS DOUBLE) AS sales,
  CAST(sum((exact_amount - CAST(totalproductcost AS DECIMAL(18,4))) * posts) AS DOUBLE) AS profit
FROM resold JOIN supplier ON resellerkey = s_suppkey + 1
JOIN (SELECT employeenationalidalternatekey AS nid, count(*) AS posts FROM employee_rows GROUP BY ALL)
  ON nid = 'NID' || (employeekey - 1)
GROUP BY ALL""", "resold", "employee_rows"),
        "datamart_dim_product": _with("""
SELECT *, CAST(substring(productalternatekey, 4) AS BIGINT) + 1 AS "ProductKey",
  englishproductname AS spanishproductname, englishproductname AS frenchproductname
FROM product_rows WHERE daystomanufacture >= 2 OR englishproductname < 'm older '
UNION ALL BY NAME
SELECT * REPLACE ('m older ' || englishproductname AS englishproductname),
  CAST(substring(productalternatekey, 4) AS BIGINT) + 1 AS "ProductKey",
  englishproductname AS spanishproductname, englishproductname AS frenchproductname
FROM product_rows WHERE daystomanufacture < 2 AND englishproductname > 'm older '""", "product_rows"),
        "datamart_dim_reseller": _with(_first_of_two(
            "reseller_rows", "resellername", "reselleralternatekey",
            "CAST(substring(reselleralternatekey, 3) AS BIGINT) + 1 AS resellerkey"), "reseller_rows"),
        "datamart_dim_sales_territory": _with(_first_of_two(
            "territory_rows", "salesterritoryregion", "salesterritoryalternatekey",
            "salesterritoryalternatekey + 1 AS salesterritorykey"), "territory_rows"),
        "datamart_dim_currency": _with(_first_of_two(
            "(SELECT currencycode AS currencyalternatekey, name AS currencyname FROM src_currency)",
            "currencyname", "currencyalternatekey",
            f"{_currency_key('currencyalternatekey')} AS currencykey"), "currency"),
        "datamart_dim_promotion": _with(_first_of_two(
            "promotion_rows", "englishpromotionname", "promotionalternatekey",
            "promotionalternatekey + 1 AS promotionkey"), "promotion_rows"),
        "datamart_dim_date": _with(_first_of_two("calendar", "englishmonthname", "datekey"), "calendar"),
        "datamart_dim_employee": _with("""
SELECT *, CAST(substring(employeenationalidalternatekey, 4) AS BIGINT) AS "EmployeeKey" FROM employee_rows
QUALIFY row_number() OVER (PARTITION BY employeenationalidalternatekey
  ORDER BY payfrequency NULLS LAST, baserate NULLS LAST) = 1""", "employee_rows"),
        "datamart_reseller_sales": _with(f"""
SELECT resellerkey, employeekey, {_FACT_COLUMNS.replace('salesamount, ', '')},
  CAST(exact_extended - exact_discount AS DOUBLE) AS "SalesAmount",
  CAST(exact_extended - exact_discount - exact_cost AS DOUBLE) AS "Profit"
FROM (SELECT *, exact_amount AS exact_extended,
  CAST(discountamount AS DECIMAL(19,4)) AS exact_discount,
  CAST(totalproductcost AS DECIMAL(19,4)) AS exact_cost FROM resold)""", "resold"),
        "incremental_scan": _with(f"""
SELECT * REPLACE (CAST(taxamt AS DOUBLE) AS taxamt, CAST(freight AS DOUBLE) AS freight)
FROM src_salesorderheader WHERE modifieddate >= {_HALFWAY}""", "salesorderheader"),
        "multi_table_read": " UNION ALL ".join(
            f"SELECT '{name}' AS name, count(*) AS row_count FROM {name}"
            for name in ("customer", "orders", "lineitem", "events")),
        "distinct_groups": _with("SELECT DISTINCT groupname FROM src_department", "department"),
        "distinct_territories": _with(
            "SELECT DISTINCT territorygroup, name, countryregioncode FROM src_salesterritory", "salesterritory"),
        "insert_only_new": _with(f"""
SELECT salesordernumber, purchaseordernumber, customerid, orderdate FROM src_salesorderheader b
WHERE NOT EXISTS (SELECT 1 FROM src_salesorderheader e WHERE e.orderdate < {_HALFWAY}
  AND e.purchaseordernumber IS NOT DISTINCT FROM b.purchaseordernumber
  AND e.customerid IS NOT DISTINCT FROM b.customerid)""", "salesorderheader"),
        "warehouse_load": _with(
            "SELECT salesordernumber, customerid, CAST(taxamt AS DOUBLE) AS taxamt, orderdate "
            "FROM src_salesorderheader", "salesorderheader"),
        "warehouse_keys": _with("""
SELECT row_number() OVER (ORDER BY storeid IS NULL, accountnumber) AS customerkey,
  accountnumber AS customeralternatekey, customerid, storeid FROM src_customer""", "customer"),
        "frame_profile": " UNION ALL ".join(
            f"""SELECT '{table}' AS table_name, '{name}' AS column_name, count(*) AS rows, count(*) - count({name}) AS nulls,
  {f'CAST(min({name}) AS DOUBLE) + 0.0' if number else 'NULL'} AS least, {f'CAST(max({name}) AS DOUBLE) + 0.0' if number else 'NULL'} AS largest,
  {'NULL' if number else f'CAST(min({name}) AS VARCHAR)'} AS "first", {'NULL' if number else f'CAST(max({name}) AS VARCHAR)'} AS "last"
FROM {table}"""
            for table, names in PROFILED.items() for name, number in names.items()),
        "constrained_load": """
WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_discount <> 0.05 THEN CAST(l_quantity AS DOUBLE) END AS l_quantity
  FROM lineitem),
parts AS (
  SELECT 1 AS part, * FROM lines WHERE l_orderkey % 3 < 2 UNION ALL SELECT 2, * FROM lines WHERE l_orderkey % 3 > 0),
batch AS (SELECT *, 1 AS copy FROM parts UNION ALL SELECT *, 2 FROM parts WHERE l_orderkey % 10 = 1),
judged AS (
  SELECT *, concat_ws('; ', 'rejected',
    CASE WHEN l_quantity IS NULL THEN 'null: l_quantity' END,
    CASE WHEN row_number() OVER (PARTITION BY part, l_orderkey, l_linenumber ORDER BY l_suppkey, l_quantity NULLS FIRST) > 1
      THEN 'repeated: l_orderkey, l_linenumber' END,
    CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10)
      THEN 'missing: l_suppkey' END) AS status FROM batch)
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, CASE status WHEN 'rejected' THEN 'loaded' ELSE status END AS status
FROM judged j WHERE status <> 'rejected' OR part = 1 OR NOT EXISTS (
  SELECT 1 FROM judged e WHERE e.part = 1 AND e.status = 'rejected'
    AND e.l_orderkey = j.l_orderkey AND e.l_linenumber = j.l_linenumber)""",
        "watermark_loads": """
WITH bounds(load, lower, upper) AS (VALUES (1, DATE '1900-01-01', DATE '1996-06-30'),
  (2, DATE '1996-07-01', DATE '1999-01-15'), (3, DATE '1999-01-16', DATE '2099-12-31'), (4, DATE '2100-01-01', DATE '2099-12-31'))
SELECT load, count(o_orderkey) AS added,
  (SELECT CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) FROM orders WHERE o_orderdate <= upper) AS watermark,
  (SELECT count(*) FROM orders) AS total_orders, (SELECT CAST(sum(o_orderkey) AS BIGINT) FROM orders) AS sum_of_keys
FROM bounds LEFT JOIN orders ON o_orderdate >= lower AND o_orderdate <= upper GROUP BY load, upper""",
        "changed_orders_load": """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
UNION ALL SELECT o_orderkey, '2030-01-01' FROM orders WHERE o_orderkey % 97 = 5 AND o_orderkey % 1009 = 7""",
        "full_replace": _with("SELECT customerid, storeid, accountnumber FROM src_customer", "customer"),
        "csv_roundtrip": _with(
            "SELECT productid, name, color, CAST(listprice AS DOUBLE) AS listprice, finishedgoodsflag "
            "FROM src_product", "product"),
        "stream_insert_only_new": "SELECT * FROM events",
        "has_new_fact_data": """
SELECT '1998-01-01' AS last_saved, max(o_orderdate) AS last_date,
  max(o_orderdate) >= DATE '1998-01-02' AS has_new FROM orders""",
        "source_is_newer": f"""
SELECT max(o_orderdate) AS source_latest, max(o_orderdate) FILTER (o_orderdate < {_HALFWAY}) AS target_latest,
  max(o_orderdate) >= {_HALFWAY} AS has_new FROM orders""",
        "has_any_row": "SELECT count(*) = 0 AS needs_load FROM events",
        "pk_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
        "not_null_violations": _with(
            " UNION ALL ".join(
                f"SELECT '{name}' AS column_name, count(*) AS null_count FROM src_salesorderheader WHERE {name} IS NULL"
                for name in ("shipdate", "purchaseordernumber", "salespersonid", "currencyrateid")),
            "salesorderheader"),
        "fk_orphans": _with("""
SELECT businessentityid, count(*) AS row_count FROM src_salespersonquotahistory
WHERE businessentityid NOT IN (SELECT businessentityid FROM src_salesperson) GROUP BY ALL""",
            "salespersonquotahistory", "salesperson"),
        "surrogate_keys": """
SELECT 99 + row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS customerkey, *
FROM customer""",
        "surrogate_keys_of_copies": """
SELECT row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS linekey, l_returnflag, l_linestatus
FROM lineitem""",
        "line_numbers": f"""
SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY {lines}, l_returnflag, l_linestatus, l_shipdate) AS line FROM lineitem""",
        "line_numbers_large_groups": f"""
SELECT *, row_number() OVER (PARTITION BY l_returnflag
  ORDER BY l_orderkey, {lines}, l_linestatus, l_shipdate) AS line FROM lineitem""",
        "parent_accounts": _with("""
SELECT c.customerid, c.accountnumber,
  CASE WHEN c.personid IS NOT NULL THEN 'RS' || c.storeid END AS parentnumber, a.customerid AS parentid
FROM src_customer c LEFT JOIN src_customer a
  ON c.personid IS NOT NULL AND a.personid IS NULL AND a.storeid = c.storeid""", "customer"),
        "dedupe_composite": """
SELECT c_custkey AS addressid, c_nationkey * 10 + CAST(substring(c_name, 18) AS INT) AS geographykey
FROM customer""",
        "translate_with_fallback": _with("""
SELECT p_partkey, p_name, CASE WHEN p_name IN (SELECT w FROM words) AND p_name NOT LIKE '%bolt%'
  THEN 'fr ' || p_name ELSE p_name END AS french_name FROM part""", "words"),
        "individual_survey": _with("""
SELECT * EXCLUDE (income) FROM survey_fields
UNION ALL BY NAME SELECT s_suppkey * 2 + 1 AS businessentityid FROM supplier""", "survey_fields"),
        "store_survey": _with("""
SELECT s_suppkey AS businessentityid, CAST(annualrevenue AS DOUBLE) AS annualrevenue, yearopened, bankname,
  annualsales, numberemployees, productline, code AS businesstypecode FROM store_fields""", "store_fields"),
        "income_midpoint": _with("""
SELECT businessentityid, income FROM survey_fields
UNION ALL SELECT s_suppkey * 2 + 1, NULL FROM supplier""", "survey_fields"),
        "person_names": """
SELECT c_custkey * 2 AS businessentityid, c_mktsegment || ' ' || substring(c_name, 10) AS name FROM customer
UNION ALL
SELECT s_suppkey * 2 + 1, 'Supplier ' || CASE WHEN s_acctbal < 0 THEN '' ELSE substring(s_name, 10) END
FROM supplier""",
        "business_types": f"""
SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN {_TYPE_OF_CODE} END AS business_type,
  CASE WHEN s_acctbal >= 0 THEN {_RHYTHM_OF_CODE} END AS order_frequency
FROM (SELECT *, {_CODE} AS code FROM supplier)""",
        "money_values": """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN CAST('1' || c_custkey || '.5' AS DOUBLE) END AS amount
FROM customer""",
        "date_keys": "SELECT event_id, year(ts) * 10000 + month(ts) * 100 + day(ts) AS datekey FROM events",
        "segment_share": """
SELECT c_mktsegment, CAST(sum(v) AS DOUBLE) AS value,
  round(CAST(sum(v) AS DOUBLE) * 100 / CAST(sum(sum(v)) OVER () AS DOUBLE), 1) AS share
FROM (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(15,2)) AS v FROM orders)
JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
        "fixed_layout": """
SELECT s_name, s_suppkey, CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS DOUBLE) AS s_acctbal,
  CAST(NULL AS VARCHAR) AS s_fax FROM supplier""",
    }
