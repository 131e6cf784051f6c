SELECT p.PARTID, p.PARTKLS, c.counterparty_id, a.sequence_no, a.segkss
FROM v_partner_info_current p
LEFT JOIN v_partner_counterparty_current c ON c.PARTID = p.PARTID
LEFT JOIN v_partner_filalkunde_current a
       ON a.PARTID = p.PARTID AND a.counterparty_id = c.counterparty_id
