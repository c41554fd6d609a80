"""Which paths of a work hold arrays (M2): only these make a pattern fan out.

Works with a work id are described in one vocabulary, works known by their DOI in another.
"""

from __future__ import annotations

#: Array paths of works with a work id, in the order of that vocabulary.
WORK_ARRAYS = frozenset(
    """
    primary_location.source.host_organization_lineage primary_location.source.host_organization_lineage_names
    best_oa_location.source.host_organization_lineage best_oa_location.source.host_organization_lineage_names
    locations locations.source.host_organization_lineage locations.source.host_organization_lineage_names
    authorships authorships.raw_affiliation_strings authorships.countries authorships.country_ids authorships.affiliations
    authorships.affiliations.institution_ids authorships.institutions authorships.institutions.lineage corresponding_author_ids
    corresponding_institution_ids referenced_works related_works indexed_in concepts topics mesh keywords sustainable_development_goals counts_by_year
    abstract_inverted_index.* versions datasets grants
    """.split()
)

#: Array paths of works known by their DOI, in the order of that vocabulary.
DOI_ARRAYS = frozenset(
    """
    ISSN alternative-id author author.affiliation author.affiliation.place author.affiliation.id author.affiliation.department
    author.affiliation.acronym container-title content-domain.domain created.date-parts deposited.date-parts indexed.date-parts issn-type
    issued.date-parts journal-issue.published-print.date-parts journal-issue.published-online.date-parts license license.start.date-parts link
    published.date-parts published-print.date-parts reference resource.secondary short-container-title title published-online.date-parts archive
    assertion subtitle updated-by updated-by.updated.date-parts relation.* funder funder.id funder.award update-to update-to.updated.date-parts
    published-other.date-parts editor editor.affiliation editor.affiliation.id editor.affiliation.place editor.affiliation.acronym
    editor.affiliation.department aliases original-title ISBN isbn-type event.end.date-parts event.start.date-parts event.sponsor accepted.date-parts
    short-title institution institution.place institution.acronym institution.department institution.id posted.date-parts approved.date-parts
    content-created.date-parts degree issue-title translator translator.affiliation translator.affiliation.id translator.affiliation.place
    clinical-trial-number award-start.date-parts project project.award-end.date-parts project.award-start.date-parts project.funding
    project.funding.funder.id project.investigator project.investigator.affiliation project.investigator.affiliation.id
    project.investigator.alternate-name project.investigator.role-start.date-parts project.investigator.role-end.date-parts project.lead-investigator
    project.lead-investigator.affiliation project.lead-investigator.affiliation.id project.lead-investigator.alternate-name
    project.lead-investigator.role-start.date-parts project.lead-investigator.role-end.date-parts project.project-title project.project-description
    project.co-lead-investigator project.co-lead-investigator.affiliation project.co-lead-investigator.affiliation.id
    project.co-lead-investigator.role-end.date-parts project.co-lead-investigator.role-start.date-parts project.award-planned-end.date-parts chair
    chair.affiliation chair.affiliation.id chair.affiliation.department chair.affiliation.acronym chair.affiliation.place content-updated.date-parts
    """.split()
)
