"""Known licences: (SPDX id, SHA-256 of the canonical form of ``licenses.canonical``), a licence as often as its text has
customary forms -- with each customary title and without one, numbered and unnumbered clauses, with and without an appendix,
old and new addresses. Texts from Debian's common licences and the licence files of installed packages.
"""

DIGESTS = (
    ("0BSD", "135f996b0799264a94667b307181b4e708ac75af3dd183e62a37bd0555cbf0cc"),
    ("0BSD", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("0BSD", "3d7b7ce2a6e224f3ce2c959b8b26ed63938ae9ac89a1a93812c66acfe9971516"),
    ("0BSD", "53695ed162cb0132fe0563719addeac105c8cad72350fae9183e2c74a7c0dbbe"),
    ("0BSD", "9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153"),
    ("Apache-2.0", "21c8ca8bd57ab27eb2e3afc84243d2efeb533d6daf288da670cbafd455c32856"),
    ("Apache-2.0", "28de6b6f31af692f3276f4c7d7f809bc7d39d3206a71fe090d61d943447aabc6"),
    ("Apache-2.0", "2dd48daf398bd8da2b5da5251508a77c61e9bc8fcf7e526023536dcb4c5c39b5"),
    ("Apache-2.0", "309ea4bddf3a87f3312c7577cc60a44cb9df024e24e503bf75da4c3387629626"),
    ("Apache-2.0", "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a"),
    ("Apache-2.0", "65e9849408944bdc476c1def7c9f1720140ef7406e3a17ab8c058a70973a31aa"),
    ("Apache-2.0", "80f8053c9eed23b75528baa067327e0de666824ae4dcdde2c199b19f41aa3d4a"),
    ("Apache-2.0", "9fac6535cb8dfff47ee2a5e24883785772fe2b9c5ba3083cbb50d9321786953f"),
    ("Apache-2.0", "b35b83acee1925f4ac31d46b381bc9d2c40dc1a05e2f34d5dabb988b86b42ab6"),
    ("Apache-2.0", "bce3807bc210c58708224588605d463cb63affaad0ac002a8a88e301fd56cb58"),
    ("Apache-2.0", "c74b66bffefe893e584184a93e1d7d4ad871f077ee9308c8820ab6e899396be3"),
    ("Apache-2.0", "c876a853e3837603a39d56da29306b74786b34411bf636ce5072eb840e764cab"),
    ("Apache-2.0", "d8221a4f10c01c6fa5390685929a5ce31d7264a024162fd3dd4d805c57ce0f43"),
    ("Apache-2.0", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2"),
    ("Apache-2.0", "ede5636533003d7b38a8e11ba0796f8a9dcf206eed1aa6a3e68ffad68318e021"),
    ("Apache-2.0", "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("Artistic-1.0-Perl", "4eaaa9e33aeef0af0ff83ab5edac0ad421a1da9cc861c564630460107b4b772c"),
    ("BSD-2-Clause", "103c98ea1dcdfdbeeec27381a3e18ee35543712a782539739ec6a31d25bc28bd"),
    ("BSD-2-Clause", "11ec916eac82380be6b3d091aa6a98571180ae1fb0312516878ddc9ebd7bbf32"),
    ("BSD-2-Clause", "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2"),
    ("BSD-2-Clause", "33903615089fdb3ab02696d1bd92eb9580c2c7a0e0c8714aa95b0dfc1dcdb89c"),
    ("BSD-2-Clause", "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2"),
    ("BSD-2-Clause", "7f5d2c72cb2d2d51609adc1fff82fcee645ad3f4500f3330cac3337580115438"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-2-Clause", "b02d799e391838a73a0ccc75692ba88eafccab18abbd5f907e855d22048655d4"),
    ("BSD-2-Clause", "b265945940ccdc41492a8c56728fe75bfaf767b67d176e33b2649c7dcf426893"),
    ("BSD-2-Clause", "bc1e385eb5d19c6613b84fb0a516cbaef80caefb192cf62a0c520c07f0fcab07"),
    ("BSD-2-Clause", "cd9b30ab197f107db04da00f4378e43d4fd8ee50988ed680ff3fed81106cb1a8"),
    ("BSD-2-Clause", "dfb735646da984cb814b2aab18aef097d6e575950073bd82353f618e44014642"),
    ("BSD-2-Clause", "e74f02edf06350e22d771b60d0580c53e28783fd12eda06abd03dab1348bc9d9"),
    ("BSD-2-Clause", "e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9"),
    ("BSD-2-Clause", "f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b"),
    ("BSD-3-Clause", "002ce4b8f1abc08327f935f87bf49584f7fc46fe8139a530cb4ce445fad613c6"),
    ("BSD-3-Clause", "214aa9c28152d6d77e6bebfb4a7511e677f65fdaf94b0fe9c0bb580e0eaf8997"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", "27fc5566f50e542addd6ee6d6da5dd182a6d4e5ebc88b6b0967d2e0a98b5c319"),
    ("BSD-3-Clause", "326c317935b3409d9750fd4ad5326ce15c9b75d313b4baf2cb9ff54accf8d903"),
    ("BSD-3-Clause", "3869a7eb34eade633338d788feeb4bab178a8f230053a14abe96d8e1fcee2046"),
    ("BSD-3-Clause", "4079d1a9108ca437dd29ac26e1f73dbf7bb3b61ba3392438373db7018cf188c3"),
    ("BSD-3-Clause", "49d4bc72a1ff6c779c3df162b67c048b3e6e670172f2d9240678059a3ea31474"),
    ("BSD-3-Clause", "4c01287765d4770188bcc961fc5046b414b09fa8b984d16021bbf024247187d1"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "5a6e7ec0b1ac1e224277a8a6d5cd7691ea38298b0308b87a7a2e539d020ed1e0"),
    ("BSD-3-Clause", "69fcedb70fd1930cb5d773bb71eb605a3aec6362c678302194666d60ca468f71"),
    ("BSD-3-Clause", "6cd2ec4c1707d264427cffd6a4120fb4ce726f221152e3e5c63f8b57d2e1693e"),
    ("BSD-3-Clause", "6f922c6cb2a22faa1c3d9be59103bf5dc2942321f1c76cc3b6f0772aa184826c"),
    ("BSD-3-Clause", "73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da"),
    ("BSD-3-Clause", "85a253fdca75357d8f16143d242204d0c291650df54bf470a94c229f0d848c65"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "ab96d546e6cc543d5b4293c719e371f5b0d14297d55a21baa6643452a92007ce"),
    ("BSD-3-Clause", "afc81ee99a150bf9ad976d1b4b3bae3ec8fb30e82c7f9ec18d0048b070d2ebc8"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "ceb36b0173297578925e297a5e163a7f0f988327f28c8eb9654153d4354b2598"),
    ("BSD-3-Clause", "d0a339eb5454123c6a1f2696aace557e0561866f3fe33b93ffad58ecfcab7060"),
    ("BSD-3-Clause", "d1ecc0a46c23dad7f9e13b19b877e5be7ec9d2b9bb05a2dfde2e47be83438590"),
    ("BSD-3-Clause", "e4d34334d1e19820930122c7816c18f12fa68d9d4a2a6d91f53e4567cdb02167"),
    ("BSD-3-Clause", "e612af111b0f62aac3e107973cd804ade8a118ba3c7034d6824ebdce9852ba2e"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("BSL-1.0", "4f4c9e65217414246c604405ee4900201bd9f230d226fa803a0b7a1f5775bf85"),
    ("BSL-1.0", "5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded"),
    ("BSL-1.0", "88376b33b906f9c611252122226eaa228686ae5885340c69e5c685fe59ac4b39"),
    ("CC-BY-NC-4.0", "e34399ae0e957e9bb9b4a0e3f615d05722861801f4e0718f35cefc762c349a16"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("CC0-1.0", "a142ae38742c8c4c35f5fa19e0a40ebfa60fc38535daf9c570ca3d7e012e1e32"),
    ("CC0-1.0", "e3ba2aff64372f535373996fe68b166f9e97dc1ead5b471981213ebb8f310ad6"),
    ("CC0-1.0", "f44ed3ff5f9a05839a5f27142f3ce4f4c5f68fe69b41aa77ffd4f250ace74b98"),
    ("GFDL-1.2-only", "46df66eb30fadb738a42b19ccce2f18a583866e5837bccc790b4acff41ba12da"),
    ("GFDL-1.2-only", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3-only", "3c426fbfcdf22792d87bb85fe1538455be3c49904a6d4c0f754f86b16154c8bf"),
    ("GFDL-1.3-only", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0-only", "7084d0106d209cde496701d21dfbe9bb489fd9bedf9778f3d718d2fe7377dfc7"),
    ("GPL-1.0-only", "d4439dc0ff9516317e43a42b4675788c5270e13e2e418a6259fc28c1399bc9d5"),
    ("GPL-1.0-only", "ec8a6b7d70e9f225b63d3962ed5b4721373f5535d7b967a06722b0d621f6892a"),
    ("GPL-2.0-only", "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6"),
    ("GPL-2.0-only", "9910575823ae522a50f0f512c388dfaad76e8ccc95929c05b4eb59235741be40"),
    ("GPL-2.0-only", "e96e14de9c3b9dd8fb9b9c693f78237578ae05d8105b2ec72bbc79daaac48990"),
    ("GPL-2.0-only", "ecf86bf703cceb586c5cfbab09dbdbdced3ee07592e0bcf2512349c3b30c9307"),
    ("GPL-2.0-only", "f70f714ab9504ebc782d1d4954598a735e2c9dc7e88e6e7c8e8e5c0e630a28b6"),
    ("GPL-2.0-only", "f8aa58042d9916a43f6a3b871af7e06be1dc4041ad3de6a0a61b2159f819edda"),
    ("GPL-3.0-only", "04a10e711844fe517f9ffba9481db6a825f2f268002c49184ecb8c942911bff3"),
    ("GPL-3.0-only", "2461d3d0f596a2725cfabaa41b961da24609b4d95a683a706bb0d3fa879a7efc"),
    ("GPL-3.0-only", "37d45dc3b9135ed58bd277e14112dfea95629cda77a8d62cdb6bcd862e7b5bf5"),
    ("GPL-3.0-only", "4f170d82a5dc4285e6543a76606bf2745bfaacdccf06e457caf34c1a9cd976e6"),
    ("GPL-3.0-only", "9faf4f9b13ca844eeee37346a77dec74f558096ac2b418782a99c8afe4c772da"),
    ("GPL-3.0-only", "d929c32580d6cb6f83ef0c5cee866d302e85882fd96bc9b5c2affe7df95e2d43"),
    ("GPL-3.0-only", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("ISC", "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"),
    ("ISC", "23651ce8a73abaa8fad9143faad3fca843b5de6baf345008f65c453ea5685fb1"),
    ("ISC", "280d76b420aeff51730e96577a2466120c91213f03dd50d60107078c498c5b29"),
    ("ISC", "40e6eb51c3b409d93549806b55b249c261dab149d19b56cc163624f39a08b1db"),
    ("ISC", "5456fff23cf44064ff54d9d973cf8a7204e2788759d3d01ba3de38afc4515eee"),
    ("ISC", "673f59dc8ad54524704b5b5d2deeb39eec917afad46597b1b7d4f2963edff317"),
    ("ISC", "8281b7122b87e54b97a6183786fef9b33350db9bfb9141855ea93e09543e1fcc"),
    ("ISC", "8ee0d4f927294d5cfe44a2a4b1faecb347cc94d0e53edd910b1abc0f6527865f"),
    ("ISC", "a285b2987fbd98096b971c73f42998e424fd3014a9690457259734f639dee8eb"),
    ("ISC", "f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee"),
    ("LGPL-2.0-only", "0e3c184176a70698802350b8f697a92e908601a66f8f622e8d4c08c9e90e0a8f"),
    ("LGPL-2.0-only", "0fa996574ca5dc180f7c2059004595865e839378c5883bf73094665cf8a8ea07"),
    ("LGPL-2.0-only", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0-only", "aa06ce7f6e464e73e65ec0efa0bc575ef5bb7059ae0137ab610c2e57b32ca95c"),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1-only", "8804689a3cb50307fb0be19fb714e5bd98636053e8d9b074178b1760e80bd36f"),
    ("LGPL-2.1-only", "e94f6c31379c2076fae91e236d6000ea55d918637fc8f30749aa0fe22a265c7f"),
    ("LGPL-3.0-only", "13980739d6423be0921994d8ce3ce547437735b0e6733161f70b19c962f194b7"),
    ("LGPL-3.0-only", "5bbd740d720a741e9b2b2a5750a4052661b057bf37bbcb0e8b582715d5fa04ad"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "0ae6a1449c55564f09306c58e84bcf7429809a582562aa93352d4acfec8c67cf"),
    ("MIT", "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MIT", "123a3b9fdc300d1b6f077f74b288de15d7f2c5b0b3b11e89fd799b48bfad5940"),
    ("MIT", "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164"),
    ("MIT", "6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f"),
    ("MIT", "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127"),
    ("MIT", "7c3366b22b9f0d6a198b2c29bd1c4b663b2d55eacbd066146e5476c4b8ff1ce4"),
    ("MIT", "d894675954a3d2aba8171e5a34d113667b9040cde3760ce9d2f5eda36b449011"),
    ("MIT-0", "33a874413c10e77f8c55d64dde413c4dc857ad4fd8fbf0784a061c94bb8e2493"),
    ("MIT-0", "a181c333030f65ebcf2eabeca3493225b6b03fce6907bdd3e59e7a8a37180fbd"),
    ("MIT-0", "e791cf58b2919e7f1591bd098943c00ee0edc689e71b7809d4d23b01824b7e6a"),
    ("MIT-0", "ea701ff4959a9d345487cc9c0ea90c4282235e7053eb61ada90e8c95f484bd04"),
    ("MIT-0", "f02e38ce878ac35aa36def58139ed31da3eef4c9e9c1ab4b3751875d209d21f9"),
    ("MPL-1.1", "34386b9a926117ec1b973ef1b1ef8fba50be254811addc9f9659bcc5d5a096bf"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "7a6eeaad6b15640cd12ad0d9c47206f91644592658d6588adbee58bb5b59cc47"),
    ("MPL-2.0", "c0f855aacb6ac1c86bcdd1334db61014d14898798ae14888fea5446cbb9d32e3"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("Unlicense", "41f84c538b3bc6dcfe6afaab48f6e16c34fd1b11b2c6be7db47873ba3bce291a"),
    ("Unlicense", "6077a8a20d606206e486caec85a30b2545701071b1e08d12c37fb9a0e490d1bf"),
    ("Unlicense", "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd"),
    ("Zlib", "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7"),
    ("Zlib", "650ad42ca78a7de669d6cdb6370d08407db85fb523ec1120eac8064af9d15be0"),
    ("Zlib", "6639a2a838439b2f70d60db893a595aca137c59bd50f4b6f5ec2be9ada5db66e"),
    ("Zlib", "8c81ff67b5987d3b4f6370ab81f9b187be4db6b537e08d1cb5d36a5a3ba2027f"),
    ("Zlib", "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a"),
    ("Zlib", "9ddc78a5797b5008d488969fd959f4281a97821e07ddc5d19ca9c163fdbeeb73"),
    ("Zlib", "a5077e3bd5e1fddc16e8af8710c266a83f01fdf5b8008ec357d075ae8185f8b2"),
    ("Zlib", "ce4547d44b78893fb1e499f1c5792469d6461ad95410bf96c70116361df6db66"),
    ("Zlib", "e8b4b40ce77fe1c6b396712780f759e806aa4252d6177655c74c2f9e80b083db"),
    ("Zlib", "ee37bc3ccba61ff28a10c05f28bdabf7466db400a75d9a1890fb865cda23e145"),
)
