"""Parties of Maryland's election certifications as the linked board documents name them."""

# Fixed values: (media id, employer, union), verified against the documents; they beat the listing's titles.
VERIFIED = (
    ("180", "University of Maryland, Baltimore", "Fraternal Order of Police, Lodge 141"),
    ("260", "Frederick County Community College", "American Federation of Teachers, Maryland"),
    ("261", "Frederick County Community College", "American Federation of Teachers, Maryland"),
    ("271", "Maryland School for the Deaf", "American Federation of Teachers, Maryland"),
    ("272", "Maryland Office of the Public Defender", "American Federation of State, County and Municipal Employees, Maryland Council 3"),
    ("273", "State of Maryland", "State Law Enforcement Officers Labor Alliance"),
    ("274", "State of Maryland", "Maryland Professional Employees Council"),
    ("275", "State of Maryland", "Maryland Federation of Nurses and Health Professionals/AFT"),
    ("276", "Office of the Comptroller; Maryland Transportation Authority; Maryland State Department of Education; State Retirement Agency", "American Federation of State, County and Municipal Employees, Council 3"),
    ("277", "Office of the Comptroller; Maryland Transportation Authority; Maryland State Department of Education; State Retirement Agency", "American Federation of State, County and Municipal Employees, Council 3"),
    ("278", "Maryland Transportation Authority", "Fraternal Order of Police, Lodge 34"),
    ("310", "Anne Arundel Community College", "Service Employees International Union, Local 500"),
    ("311", "Frederick County Community College", "American Federation of Teachers, Maryland"),
    ("312", "Howard County Community College", "American Federation of Teachers, Maryland"),
    ("313", "Wor-Wic Community College", "Maryland State Education Association"),
    ("314", "Prince George's Community College", "American Federation of Teachers, Maryland"),
    ("315", "University of Maryland Center for Environmental Science", "Maryland Classified Employees Association"),
    ("319", "Garrett County Public Schools", "Garrett County Administrators and Supervisors Association/MSEA/NEA"),
    ("346", "Salisbury University", "Maryland Classified Employees Association"),
    ("359", "Bowie State University", "Maryland Classified Employees Association"),
    ("379", "University of Baltimore", "American Federation of State, County and Municipal Employees"),
    ("385", "Frostburg State University", "Fraternal Order of Police, Lodge 147"),
    ("386", "Salisbury University", "Fraternal Order of Police, Lodge 111"),
    ("391", "State of Maryland", "American Federation of State, County and Municipal Employees, Maryland Council 3"),
    ("412", "Frederick County Community College", "American Federation of Teachers, Maryland"),
    ("416", "Hagerstown Community College", "American Federation of Teachers, Maryland"),
    ("417", "Chesapeake College", "American Federation of Teachers, Maryland"),
    ("418", "Howard Community College", "Service Employees International Union, Local 500"),
    ("419", "Baltimore City Community College", "American Federation of Teachers, Maryland"),
    ("423", "Calvert County Public Schools", "Calvert Association of Supervisors and Administrators/MSEA/NEA"),
    ("425", "Anne Arundel Community College", "Service Employees International Union, Local 500"),
    ("428", "Harford Community College", "Maryland State Education Association"),
    ("431", "Anne Arundel Community College", "Maryland State Education Association"),
    ("432", "Washington County Public Schools", "Washington County Association of Supervisors and Administrators/MSEA/NEA"),
    ("486", "Community College of Baltimore County", "American Federation of Teachers, Maryland"),
    ("492", "Alcohol, Tobacco and Cannabis Commission", "State Law Enforcement Officers Labor Alliance"),
    ("500", "State of Maryland", "Maryland Professional Employees Council"),
)
