"""Output layouts as DDL texts.  Column order and names are fixed values."""

# Eight decimals, as the product of two amounts with four has, and thirty digits before them.
MONEY = "DECIMAL(38,8)"

DIM_DATE = """datekey INT, fulldatealternatekey TIMESTAMP_NTZ, daynumberofweek INT,
    englishdaynameofweek STRING, spanishdaynameofweek STRING, frenchdaynameofweek STRING,
    daynumberofmonth INT, daynumberofyear INT, weeknumberofyear INT,
    englishmonthname STRING, spanishmonthname STRING, frenchmonthname STRING,
    monthnumberofyear INT, calendarquarter INT, calendaryear INT, calendarsemester INT,
    fiscalquarter INT, fiscalyear INT, fiscalsemester INT"""

DIM_PRODUCT_CATEGORY = """productcategoryalternatekey INT, englishproductcategoryname STRING,
    spanishproductcategoryname STRING, frenchproductcategoryname STRING"""

DIM_PRODUCT_SUBCATEGORY = """productsubcategoryalternatekey INT,
    englishproductsubcategoryname STRING, productcategorykey INT,
    spanishproductsubcategoryname STRING, frenchproductsubcategoryname STRING"""

DIM_PRODUCT = f"""englishproductname STRING, productalternatekey STRING, listprice {MONEY},
    color STRING, size STRING, weight DECIMAL(8,2), weightunitmeasurecode STRING,
    sizeunitmeasurecode STRING, standardcost {MONEY}, finishedgoodsflag BOOLEAN,
    safetystocklevel INT, reorderpoint INT, daystomanufacture INT, productline STRING,
    class STRING, style STRING, startdate TIMESTAMP_NTZ, enddate TIMESTAMP_NTZ,
    productsubcategorykey INT, spanishproductname STRING, frenchproductname STRING,
    sizerange STRING, modelname STRING, status STRING"""

DIM_CURRENCY = "currencyalternatekey STRING, currencyname STRING"

DIM_PROMOTION = """promotionalternatekey INT, englishpromotionname STRING, discountpct DOUBLE,
    englishpromotiontype STRING, englishpromotioncategory STRING, startdate TIMESTAMP_NTZ,
    enddate TIMESTAMP_NTZ, minqty INT, maxqty INT, spanishpromotionname STRING,
    frenchpromotionname STRING, spanishpromotiontype STRING, frenchpromotiontype STRING,
    spanishpromotioncategory STRING, frenchpromotioncategory STRING"""

DIM_SALES_REASON = """salesreasonalternatekey INT, salesreasonname STRING,
    salesreasonreasontype STRING"""

DIM_SALES_TERRITORY = """salesterritoryalternatekey INT, salesterritoryregion STRING,
    salesterritorycountry STRING, salesterritorygroup STRING"""

DIM_GEOGRAPHY = """city STRING, stateprovincecode STRING, stateprovincename STRING,
    countryregioncode STRING, englishcountryregionname STRING, postalcode STRING,
    salesterritorykey INT, spanishcountryregionname STRING, frenchcountryregionname STRING,
    ipaddresslocator STRING"""

DIM_EMPLOYEE = f"""parentemployeekey BIGINT, parentemployeenationalidalternatekey STRING,
    salesterritorykey BIGINT, firstname STRING, lastname STRING, middlename STRING,
    namestyle BOOLEAN, title STRING, hiredate TIMESTAMP_NTZ, birthdate TIMESTAMP_NTZ,
    loginid STRING, emailaddress STRING, phone STRING, maritalstatus STRING,
    emergencycontactname STRING, emergencycontactphone STRING, salariedflag BOOLEAN,
    gender STRING, payfrequency INT, baserate {MONEY}, vacationhours INT, sickleavehours INT,
    currentflag BOOLEAN, salespersonflag BOOLEAN, departmentname STRING,
    startdate TIMESTAMP_NTZ, enddate TIMESTAMP_NTZ, status STRING, employeephoto STRING,
    employeenationalidalternatekey STRING"""

DIM_CUSTOMER = """customeralternatekey STRING, geographykey INT, namestyle BOOLEAN,
    title STRING, firstname STRING, middlename STRING, lastname STRING, suffix STRING,
    emailaddress STRING, addressline1 STRING, addressline2 STRING, birthdate STRING,
    maritalstatus STRING, yearlyincome DOUBLE, gender STRING, totalchildren STRING,
    numberchildrenathome STRING, englisheducation STRING, englishoccupation STRING,
    houseownerflag STRING, numbercarsowned STRING, commutedistance STRING,
    datefirstpurchase STRING, spanisheducation STRING, frencheducation STRING,
    spanishoccupation STRING, frenchoccupation STRING"""

DIM_RESELLER = """geographykey BIGINT, reselleralternatekey STRING, phone STRING,
    businesstype STRING, resellername STRING, numberemployees INT, orderfrequency STRING,
    ordermonth INT, firstorderyear INT, lastorderyear INT, productline STRING,
    addressline1 STRING, addressline2 STRING, annualsales DOUBLE, bankname STRING,
    minpaymenttype STRING, minpaymentamount DOUBLE, annualrevenue DOUBLE, yearopened INT"""

_SALES_MEASURES = f"""promotionkey BIGINT, currencykey BIGINT, salesterritorykey BIGINT,
    salesordernumber STRING, salesorderlinenumber INT, revisionnumber INT, orderquantity INT,
    unitprice {MONEY}, extendedamount {MONEY}, unitpricediscountpct {MONEY},
    discountamount {MONEY}, productstandardcost {MONEY}, totalproductcost {MONEY},
    salesamount {MONEY}, taxamt {MONEY}, freight {MONEY}, carriertrackingnumber STRING,
    customerponumber STRING, orderdate TIMESTAMP_NTZ, duedate TIMESTAMP_NTZ,
    shipdate TIMESTAMP_NTZ, saved DATE"""

FACT_INTERNET_SALES = f"""productkey BIGINT, orderdatekey INT, duedatekey INT,
    shipdatekey INT, customerkey BIGINT, {_SALES_MEASURES}"""

FACT_RESELLER_SALES = f"""productkey BIGINT, orderdatekey INT, duedatekey INT,
    shipdatekey INT, resellerkey BIGINT, employeekey BIGINT, {_SALES_MEASURES}"""

FACT_SALES_REASON = """salesordernumber STRING, salesorderlinenumber INT,
    salesreasonkey BIGINT, saved DATE"""

FACT_SURVEY_RESPONSE = """datekey INT, customerkey BIGINT, productcategorykey BIGINT,
    englishproductcategoryname STRING, productsubcategorykey BIGINT,
    englishproductsubcategoryname STRING, date TIMESTAMP_NTZ"""

FACT_SALES_QUOTA = f"""employeekey BIGINT, datekey INT, calendaryear INT,
    calendarquarter INT, salesamountquota {MONEY}, date TIMESTAMP_NTZ"""

DIM_DEPARTMENT_GROUP = """departmentgroupkey BIGINT, parentdepartmentgroupkey BIGINT,
    departmentgroupname STRING"""

DIM_ORGANIZATION = """organizationkey BIGINT, parentorganizationkey BIGINT,
    percentageofownership DOUBLE, organizationname STRING, currencykey BIGINT"""

DIM_SCENARIO = "scenariokey INT, scenarioname STRING"

DIM_ACCOUNT = """accountkey INT, parentaccountkey INT, accountalternatekey STRING,
    accountdescription STRING, accounttype STRING, valuetype STRING, accountgroup STRING"""
